"""B101: metric packs over the activity, sales and account tables."""

from pyspark.sql import functions as F

from tidewater.functions.columns import line_revenue
from tidewater.operators.packs import Pack, hits, mean, over, percentile, rate, run, total, uniq
from tidewater.plans.registry import ORACLES, QUERIES
from tidewater.sources.tables import Tables


def activity(t: Tables):
    """One row per event, with its calendar parts and the number in its properties."""
    return t.events.select("event_id", "user_id", F.col("event_type").alias("kind"), F.col("value").alias("amount"), F.from_json("props", "k int")["k"].alias("k"),
                           F.to_date("ts").alias("day"), F.unix_date(F.to_date("ts")).alias("day_no"), F.hour("ts").alias("hour"), F.dayofweek("ts").alias("dow"))


def sales(t: Tables):
    """One row per order line with its order, part and delays."""
    return (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("customer"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("p_brand").alias("brand"),
                    F.col("p_type").alias("category"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("qty"),
                    F.col("l_extendedprice").alias("price"), F.round(line_revenue(), 4).alias("net"), F.col("l_discount").alias("discount"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("retail"),
                    F.to_date("o_orderdate").alias("day"), F.unix_date(F.to_date("o_orderdate")).alias("day_no"), F.date_format("o_orderdate", "yyyy-MM").alias("month"),
                    F.datediff("l_shipdate", "o_orderdate").alias("delay")))


def accounts(t: Tables):
    """One row per customer with nation and region."""
    return (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("customer"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), F.col("r_name").alias("region")))


SOURCES = {"activity": activity, "sales": sales, "accounts": accounts}

SOURCE_SQL = {
    "activity": """SELECT event_id, user_id, event_type AS kind, value AS amount, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(ts::DATE AS VARCHAR) AS day, date_diff('day', DATE '1970-01-01', ts::DATE) AS day_no,
        hour(ts) AS hour, dayofweek(ts) + 1 AS dow FROM events""",
    "sales": """SELECT l_orderkey AS order_id, o_custkey AS customer, l_partkey AS part, l_suppkey AS supplier, p_brand AS brand, p_type AS category, o_orderpriority AS priority, o_orderstatus AS status, l_returnflag AS flag,
        l_quantity AS qty, l_extendedprice AS price, round(l_extendedprice * (1 - l_discount), 4) AS net, l_discount AS discount, p_size AS size, p_retailprice AS retail, CAST(o_orderdate::DATE AS VARCHAR) AS day,
        date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS day_no, strftime(o_orderdate, '%Y-%m') AS month, date_diff('day', o_orderdate, l_shipdate) AS delay
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "accounts": """SELECT c_custkey AS customer, c_acctbal AS balance, c_mktsegment AS segment, n_name AS nation, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
}

N = "count(*)"
GAP = over("max(day_no) - min(day_no)", "count(distinct day_no) - 1")
net_total = "round(sum(net), 4)"

PACKS = {
    "network_connections": Pack("activity", ("user_id",), {"connection_count": uniq("k")}),
    "card_transactions": Pack("activity", ("user_id",), {"avg_amount": mean("amount"), "transaction_count": N, "fraud_count": hits("amount > 150"), "total_spent": total("amount"), "fraud_rate": rate("amount > 150")}),
    "shop_products": Pack("sales", ("part",), {"total_sold": total("qty"), "total_revenue": net_total, "unique_customers": uniq("customer")}),
    "shop_customers": Pack("sales", ("customer",), {"lifetime_value": net_total, "order_count": uniq("order_id"), "days_since_first_order": "max(11566 - day_no)"}),
    "query_times": Pack("activity", ("kind",), {"avg_execution_time": mean("amount"), "max_execution_time": "max(amount)", "query_count": N}),
    "value_ranges": Pack("accounts", ("nation",), {"avg_value": mean("balance"), "max_value": "max(balance)", "min_value": "min(balance)"}),
    "retail_payments": Pack("sales", ("category",), {"total_sales": net_total, "transaction_count": uniq("order_id"), "units_sold": total("qty"), "avg_inventory": mean("size")}, deal=("category", "order_id")),
    "enterprise_usage": Pack("activity", ("kind", "dow"), {"active_users": uniq("user_id"), "total_usage": total("amount"), "softwares_used": uniq("k"), "avg_usage_hours": mean("amount")}),
    "tech_products": Pack("sales", ("brand",), {"total_revenue": net_total, "total_units": total("qty"), "first_sale_date": "min(day)"}),
    "first_month_sales": Pack("sales", ("brand", "month"), {"first_month_revenue": net_total, "first_month_units": total("qty")}),
    "store_sales": Pack("sales", ("supplier",), {"total_revenue": net_total, "total_units": total("qty"), "unique_customers": uniq("customer")}),
    "store_categories": Pack("sales", ("supplier", "category"), {"category_revenue": net_total, "category_units": total("qty")}),
    "delivery_logistics": Pack("sales", ("priority",), {"avg_delivery_time": mean("delay"), "delivery_count": N, "on_time_deliveries": hits("delay between 0 and 60"), "total_distance": total("size"), "total_deliveries": uniq("order_id")}),
    "ride_hours": Pack("activity", ("hour", "dow"), {"ride_count": N, "avg_fare": mean("amount"), "avg_distance": mean("k")}),
    "ride_drivers": Pack("activity", ("user_id",), {"total_rides": N, "avg_rating": mean("k"), "total_fare": total("amount")}),
    "bank_transactions": Pack("activity", ("user_id", "kind"), {"total_amount": total("amount"), "transaction_count": N, "avg_amount": mean("amount")}),
    "bank_assets": Pack("accounts", ("segment",), {"avg_balance": mean("balance"), "total_assets": total("balance"), "account_count": N}),
    "search_advertising": Pack("activity", ("day",), {"search_count": hits("kind = 'view'"), "avg_results": mean("k"), "clicks": hits("kind = 'click'"), "total_impressions": hits("kind in ('view', 'click')"), "total_revenue": total("amount"),
                                                     "click_through_rate": rate("kind = 'click'", "kind in ('view', 'click')")}),
    "cloud_usage": Pack("activity", ("kind",), {"total_usage_hours": total("k"), "avg_cost": mean("amount"), "active_customers": uniq("user_id")}),
    "crm_contracts": Pack("sales", ("status",), {"customer_count": uniq("customer"), "avg_contract_value": mean("net"), "total_revenue": net_total}),
    "travel_bookings": Pack("sales", ("month",), {"booking_count": uniq("order_id"), "total_revenue": net_total, "avg_nights": mean("size"), "avg_rating": mean("qty")}),
    "professional_activity": Pack("activity", ("user_id",), {"activity_count": N, "total_duration": total("amount"), "view_count": hits("kind = 'view'"), "avg_rating": mean("k"), "total_shares": hits("kind = 'click'")}),
    "hardware_sales": Pack("sales", ("brand", "priority"), {"total_units": total("qty"), "total_revenue": net_total, "avg_price": mean("price"), "regional_revenue": total("price"), "regional_units": N}),
    "marketplace_reviews": Pack("activity", ("k",), {"review_count": N, "avg_helpful_votes": mean("amount"), "avg_product_rating": mean("dow"), "total_helpful_votes": total("amount")}),
    "stream_watching": Pack("activity", ("user_id",), {"total_watch_time": total("amount"), "unique_viewers": uniq("day"), "avg_rating": mean("k"), "unique_content": uniq("k")}),
    "vehicle_use": Pack("activity", ("user_id",), {"total_distance": total("k"), "avg_efficiency": over("sum(amount)", "sum(k)"), "total_energy_used": total("amount"), "avg_charging_time": mean("case when kind = 'error' then amount end"), "charging_sessions": hits("kind = 'error'")}),
    "consulting_budget": Pack("sales", ("supplier",), {"total_revenue": net_total, "avg_duration": mean("delay"), "total_budget": total("price"), "avg_utilization": mean("1 - discount"), "total_hours_billed": total("qty")}),
    "hospitality": Pack("sales", ("category",), {"avg_price": mean("price"), "total_revenue": net_total, "avg_rating": mean("qty"), "booking_count": uniq("order_id")}, deal=("category", "order_id")),
    "software_licences": Pack("activity", ("kind",), {"active_users": uniq("user_id"), "total_usage_hours": total("amount"), "avg_sessions": over("count(*)", "count(distinct user_id)"), "actual_users": uniq("user_id"), "licensed_users": uniq("k")}),
    "mobility": Pack("activity", ("hour",), {"ride_count": N, "total_fare": total("amount"), "avg_distance": mean("k"), "avg_surge": mean("case when amount > 100 then 2 else 1 end")}),
    "search_sessions": Pack("activity", ("user_id", "day"), {"query_count": N, "avg_results": mean("k"), "total_clicks": hits("kind = 'click'"), "avg_session_length": mean("amount"), "click_through_rate": rate("kind = 'click'")}),
    "order_patterns": Pack("sales", ("order_id",), {"order_value": net_total, "item_count": N, "products": uniq("part")}, deal=("order_id",)),
    "social_activity": Pack("activity", ("user_id",), {"total_likes": hits("kind = 'click'"), "total_shares": hits("kind = 'purchase'"), "total_comments": hits("kind = 'view'"), "activity_count": N, "total_duration": total("amount")}),
    "social_engagement": Pack("activity", ("user_id",), {"total_posts": N, "total_likes": hits("kind = 'click'"), "total_shares": hits("kind = 'purchase'"), "total_comments": hits("kind = 'view'"), "avg_likes_per_post": over(hits("kind = 'click'"), N), "total_followers": uniq("k"), "video_posts": hits("amount > 100")},
                              derived={"engagement_score": "round(1e0 * (total_likes + 2 * total_comments + 3 * total_shares) / nullif(total_posts, 0), 6)"}, rank=("engagement_rank", "engagement_score")),
    "fulfilment": Pack("sales", ("supplier",), {"total_orders": uniq("order_id"), "avg_processing_time": mean("delay"), "total_order_value": net_total, "delayed_orders": hits("delay > 60"), "returned_orders": hits("flag = 'R'"), "delay_rate": rate("delay > 60"), "return_rate": rate("flag = 'R'")}),
    "search_metrics": Pack("activity", ("day",), {"total_searches": N, "avg_results": mean("k"), "overall_ctr": rate("kind = 'click'"), "top3_ctr": rate("kind = 'click' and k <= 3"), "unique_users": uniq("user_id"), "no_click_searches": hits("kind <> 'click'"), "no_click_rate": rate("kind <> 'click'")}),
    "ride_sharing": Pack("activity", ("user_id",), {"total_rides": N, "avg_fare": mean("amount"), "avg_rating": mean("k"), "total_earnings": total("amount"), "avg_wait_time": mean("hour"), "surge_rides": hits("amount > 100"), "five_star_rides": hits("k >= 90"), "five_star_rate": rate("k >= 90")}),
    "software_usage": Pack("activity", ("kind",), {"active_users": uniq("user_id"), "avg_session_length": mean("amount"), "total_feature_usage": total("k"), "unique_features_used": uniq("k"), "avg_crashes": mean("case when kind = 'error' then 1 else 0 end"), "premium_users": "count(distinct case when amount > 150 then user_id end)",
                                                  "p95_session_length": percentile("amount", 0.95), "premium_rate": over("100 * count(distinct case when amount > 150 then user_id end)", "count(distinct user_id)")}),
    "system_monitoring": Pack("activity", ("user_id",), {"avg_cpu_usage": mean("k"), "avg_memory_usage": mean("amount"), "avg_disk_usage": mean("hour"), "high_cpu_events": hits("k > 90"), "high_memory_events": hits("amount > 150"), "max_response_time": "max(amount)", "avg_response_time": mean("amount"),
                                                        "unique_errors": "count(distinct case when kind = 'error' then k end)", "total_errors": hits("kind = 'error'")}),
    "vehicle_telematics": Pack("activity", ("user_id",), {"avg_battery_level": mean("k"), "total_miles": total("amount"), "avg_energy_consumption": mean("amount"), "charging_sessions": hits("kind = 'click'"), "avg_charging_time": mean("case when kind = 'click' then amount end"), "low_battery_events": hits("k < 20"),
                                                         "total_odometer": "max(amount)", "avg_temperature": mean("hour"), "mileage_efficiency_correlation": "round(corr(amount, k), 6)"}),
    "content_streaming": Pack("activity", ("k",), {"unique_viewers": uniq("user_id"), "total_watch_time": total("amount"), "avg_watch_time": mean("amount"), "total_views": N, "completed_views": hits("kind = 'purchase'"), "avg_rating": mean("dow"), "p90_watch_time": percentile("amount", 0.9), "completion_rate": rate("kind = 'purchase'")}),
    "shopper_behaviour": Pack("sales", ("customer",), {"total_orders": uniq("order_id"), "lifetime_value": net_total, "avg_order_value": over("sum(net)", "count(distinct order_id)"), "first_order_date": "min(day)", "last_order_date": "max(day)", "categories_purchased": uniq("category"),
                                                      "electronics_orders": "count(distinct case when category = 'SMALL' then order_id end)", "avg_days_between_orders": GAP}, rank=("spending_rank", "lifetime_value")),
    "gpu_usage": Pack("activity", ("user_id",), {"active_users": uniq("day"), "avg_gpu_usage": mean("k"), "avg_memory_usage": mean("amount"), "avg_temperature": mean("hour"), "total_render_time": total("amount"), "total_jobs": N, "avg_job_time": mean("amount"), "completed_jobs": hits("kind <> 'error'"), "success_rate": rate("kind <> 'error'")}),
    "user_engagement": Pack("activity", ("user_id",), {"total_sessions": N, "avg_session_minutes": mean("amount"), "total_uploads": hits("kind = 'purchase'"), "total_downloads": hits("kind = 'view'"), "total_storage_used": total("amount"), "total_connections": uniq("k"), "avg_connection_strength": mean("k"),
                                                      "premium_days": "count(distinct case when amount > 100 then day end)", "active_days": uniq("day"), "premium_usage_rate": over("100 * count(distinct case when amount > 100 then day end)", "count(distinct day)")}),
    "booking_patterns": Pack("sales", ("month", "category"), {"total_bookings": uniq("order_id"), "avg_booking_value": mean("net"), "avg_stay_length": mean("size"), "realized_revenue": "round(sum(case when status = 'F' then net else 0 end), 4)", "cancellations": hits("flag = 'R'"), "avg_review_score": mean("qty"), "cancellation_rate": rate("flag = 'R'")}, deal=("month", "category", "order_id")),
    "crm_pipeline": Pack("sales", ("supplier",), {"total_opportunities": N, "total_deal_size": net_total, "avg_deal_size": mean("net"), "won_deal_size": "round(sum(case when status = 'F' then net else 0 end), 4)", "won_opportunities": hits("status = 'F'"), "avg_sales_cycle_days": mean("delay"), "win_rate": rate("status = 'F'")}),
    "search_analytics": Pack("activity", ("hour",), {"total_searches": N, "click_through_rate": rate("kind = 'click'"), "avg_results": mean("k"), "unique_users": uniq("user_id"), "top3_clicks": hits("kind = 'click' and k <= 3"), "total_clicks": hits("kind = 'click'"), "top3_click_rate": rate("kind = 'click' and k <= 3", "kind = 'click'")}),
    "portfolio": Pack("sales", ("customer",), {"unique_assets": uniq("part"), "total_portfolio_value": net_total, "total_investment": total("retail * qty"), "avg_volatility": mean("discount"), "profitable_assets": hits("net > retail * qty"), "total_assets": N},
                      derived={"total_gain_loss": "round(total_portfolio_value - total_investment, 4)", "return_percentage": "round(100 * (total_portfolio_value - total_investment) / nullif(total_investment, 0), 6)"}),
    "ride_analytics": Pack("activity", ("hour", "kind"), {"total_rides": N, "avg_fare": mean("amount"), "avg_distance": mean("k"), "avg_rating": mean("dow"), "surge_rides": hits("amount > 100"), "avg_wait_time": mean("k"), "total_revenue": total("amount"), "surge_rate": rate("amount > 100")}),
    "delivery_performance": Pack("sales", ("priority", "status"), {"total_deliveries": N, "avg_delivery_duration": mean("delay"), "on_time_rate": rate("delay between 0 and 60"), "total_order_value": net_total, "avg_tip": mean("price * 0.01"), "five_star_ratings": hits("qty >= 40"), "avg_distance": mean("size"), "five_star_rate": rate("qty >= 40")}),
    "inventory_optimization": Pack("sales", ("part",), {"avg_daily_sales": mean("qty"), "avg_inventory": mean("size"), "out_of_stock_days": hits("qty > size"), "total_lost_sales": total("case when qty > size then qty - size else 0 end"), "total_days": uniq("day"), "days_of_supply": over("avg(size)", "avg(qty)"), "out_of_stock_rate": rate("qty > size")}),
    "sales_inventory_correlation": Pack("sales", ("brand",), {"sales_inventory_correlation": "round(corr(qty, size), 6)", "total_days": uniq("day")}),
    "product_adoption": Pack("activity", ("k",), {"active_users": uniq("user_id"), "avg_session_minutes": mean("amount"), "total_feature_uses": N, "unique_features_used": uniq("kind"), "avg_crashes_per_session": mean("case when kind = 'error' then 1 else 0 end"), "premium_users": "count(distinct case when amount > 100 then user_id end)",
                                                 "p95_session_duration": percentile("amount", 0.95), "premium_conversion_rate": over("100 * count(distinct case when amount > 100 then user_id end)", "count(distinct user_id)")}),
    "software_sessions": Pack("activity", ("dow",), {"active_users": uniq("user_id"), "avg_session_duration": mean("amount"), "total_feature_usage": total("k"), "unique_features_used": uniq("k"), "avg_crash_rate": rate("kind = 'error'"), "premium_users": "count(distinct case when amount > 150 then user_id end)",
                                                    "premium_conversion_rate": over("100 * count(distinct case when amount > 150 then user_id end)", "count(distinct user_id)")}),
    "payment_processing": Pack("activity", ("user_id",), {"transaction_count": N, "total_volume": total("amount"), "avg_transaction_size": mean("amount"), "successful_transactions": hits("kind <> 'error'"), "failed_transactions": hits("kind = 'error'"), "chargebacks": hits("kind = 'error' and amount > 100"), "success_rate": rate("kind <> 'error'"),
                                                         "chargeback_rate": rate("kind = 'error' and amount > 100")}),
    "database_performance": Pack("activity", ("hour",), {"avg_used_percent": mean("k"), "max_used_percent": "max(k)", "avg_active_sessions": mean("amount"), "peak_active_sessions": "max(amount)", "avg_cpu_usage": mean("k"), "high_usage_events": hits("k > 85"), "high_session_events": hits("amount > 100"), "unique_wait_events": uniq("kind")}),
    "supply_chain": Pack("sales", ("supplier", "category"), {"avg_daily_demand": mean("qty"), "avg_inventory_level": mean("size"), "avg_lead_time": mean("delay"), "stockout_days": hits("qty > size"), "total_days": uniq("day"), "total_lost_sales": total("case when qty > size then qty - size else 0 end"), "stockout_rate": rate("qty > size"),
                                                            "days_of_supply": over("avg(size)", "avg(qty)")}),
    "card_spending": Pack("activity", ("user_id",), {"transaction_count": N, "total_spent": total("amount"), "avg_transaction_size": mean("amount"), "first_transaction": "min(day)", "last_transaction": "max(day)", "unique_merchants": uniq("k"), "fraud_count": hits("amount > 150"), "p95_transaction_size": percentile("amount", 0.95), "fraud_rate": rate("amount > 150")}),
    "professional_network": Pack("activity", ("user_id",), {"total_connections": N, "unique_companies": uniq("k"), "unique_industries": uniq("kind"), "avg_connection_strength": mean("amount"), "premium_connections": hits("amount > 100"), "unique_skills": uniq("hour"), "premium_connection_rate": rate("amount > 100")}),
    "transaction_analysis": Pack("activity", ("user_id",), {"transaction_count": N, "total_amount": total("amount"), "avg_transaction_size": mean("amount"), "first_transaction": "min(day)", "last_transaction": "max(day)", "large_transactions": hits("amount > 100"), "amount_volatility": "round(stddev_samp(amount), 6)", "large_transaction_percentage": rate("amount > 100")}),
    "social_reach": Pack("activity", ("kind",), {"total_posts": N, "total_likes": hits("k > 50"), "total_shares": hits("k > 80"), "total_comments": hits("k < 20"), "avg_likes_per_post": over(hits("k > 50"), N), "total_followers": uniq("user_id")},
                         derived={"engagement_score": "round(1e0 * (total_likes + total_shares + total_comments) / nullif(total_followers, 0), 6)"}, rank=("engagement_rank", "engagement_score")),
    "network_devices": Pack("activity", ("user_id",), {"avg_cpu_usage": mean("k"), "avg_memory_usage": mean("amount"), "avg_network_throughput": mean("hour"), "high_cpu_events": hits("k > 90"), "high_memory_events": hits("amount > 150"), "last_online": "max(day)"}, tier=("status", "high_cpu_events", ((3, "healthy"), (8, "warning")), "critical")),
    "shopper_tiers": Pack("sales", ("customer",), {"total_orders": uniq("order_id"), "total_spent": net_total, "avg_order_value": over("sum(net)", "count(distinct order_id)"), "first_order_date": "min(day)", "last_order_date": "max(day)", "categories_purchased": uniq("category"), "avg_days_between_orders": GAP},
                          tier=("customer_tier", "total_spent", ((1000000, "bronze"), (2000000, "silver"), (3000000, "gold")), "platinum")),
    "music_streaming": Pack("activity", ("k",), {"total_tracks": uniq("event_id"), "total_streams": N, "avg_stream_duration": mean("amount"), "unique_listeners": uniq("user_id"), "completed_streams": hits("kind = 'purchase'"), "total_revenue": total("amount"), "completion_rate": rate("kind = 'purchase'")}),
    "consulting_projects": Pack("sales", ("customer",), {"total_billable_hours": total("qty"), "total_revenue": net_total, "avg_hourly_rate": over("sum(net)", "sum(qty)"), "unique_consultants": uniq("supplier"), "avg_satisfaction": mean("size"), "early_completions": hits("delay < 0"), "total_milestones": N, "early_completion_rate": rate("delay < 0")}),
    "ad_performance": Pack("activity", ("k",), {"unique_users": uniq("user_id"), "impressions": hits("kind = 'view'"), "clicks": hits("kind = 'click'"), "conversions": hits("kind = 'purchase'"), "total_revenue": total("amount"), "ctr": over("100 * " + hits("kind = 'click'"), hits("kind = 'view'")), "conversion_rate": over("100 * " + hits("kind = 'purchase'"), hits("kind = 'click'"))}),
    "search_ranking": Pack("activity", ("day",), {"top3_ctr": rate("kind = 'click' and k <= 3", "k <= 3"), "top10_ctr": rate("kind = 'click' and k <= 10", "k <= 10"), "total_searches": N, "avg_results": mean("k"), "no_click_searches": hits("kind <> 'click'"), "click_searches": hits("kind = 'click'"), "overall_ctr": rate("kind = 'click'")}),
    "short_posts": Pack("activity", ("user_id",), {"total_tweets": N, "total_likes": hits("kind = 'click'"), "total_retweets": hits("kind = 'purchase'"), "total_replies": hits("kind = 'view'"), "avg_likes_per_tweet": over(hits("kind = 'click'"), N), "unique_hashtags": uniq("k"), "engagement_rate": rate("kind in ('click', 'purchase', 'view')")}),
    "driver_performance": Pack("activity", ("user_id",), {"total_rides": N, "avg_rating": mean("k"), "total_earnings": total("amount"), "avg_fare": mean("amount"), "surge_rides": hits("amount > 100"), "avg_trip_duration_seconds": mean("amount * 60"), "five_star_rides": hits("k >= 90"), "five_star_rate": rate("k >= 90")}),
    "content_engagement": Pack("activity", ("k",), {"unique_viewers": uniq("user_id"), "total_watch_time": total("amount"), "avg_watch_time": mean("amount"), "total_views": N, "completion_views": hits("kind = 'purchase'"), "completion_rate": rate("kind = 'purchase'")}),
    "listing_market": Pack("sales", ("brand",), {"total_listings": uniq("part"), "avg_price": mean("price"), "avg_rating": mean("qty"), "total_bookings": uniq("order_id"), "total_revenue": net_total, "avg_stay_length": mean("size")}),
    "customer_segments": Pack("sales", ("customer",), {"total_orders": uniq("order_id"), "lifetime_value": net_total, "first_order_date": "min(day)", "last_order_date": "max(day)", "avg_days_between_orders": GAP, "unique_categories": uniq("category")}, tier=("customer_segment", "total_orders", ((3, "new"), (8, "regular")), "loyal")),
    "retail_stock": Pack("sales", ("brand",), {"avg_daily_sales": mean("qty"), "avg_inventory": mean("size"), "out_of_stock_days": hits("qty > size"), "total_days": uniq("day"), "days_of_supply": over("avg(size)", "avg(qty)"), "out_of_stock_rate": rate("qty > size")}),
    "social_network": Pack("activity", ("user_id",), {"friend_count": uniq("k"), "post_count": N, "avg_likes_per_post": mean("amount"), "total_comments": hits("kind = 'view'"), "groups_joined": uniq("hour")}, rank=("social_rank", "friend_count")),
    "licence_usage": Pack("activity", ("kind",), {"active_users": uniq("user_id"), "active_devices": uniq("k"), "avg_session_duration": mean("amount"), "heavy_users": "count(distinct case when amount > 100 then user_id end)", "last_usage_date": "max(day)"}),
    "app_store": Pack("sales", ("category",), {"avg_rating": mean("qty"), "total_apps": uniq("part"), "total_downloads": N, "avg_price": mean("price"), "highly_rated_apps": "count(distinct case when qty >= 45 then part end)", "highly_rated_percentage": over("100 * count(distinct case when qty >= 45 then part end)", "count(distinct part)")}, deal=("category", "part")),
    "inventory_turnover": Pack("sales", ("part",), {"total_sold": total("qty"), "avg_inventory": mean("size"), "selling_days": uniq("day"), "inventory_turnover": over("sum(qty)", "avg(size)")}),
    "card_declines": Pack("activity", ("day",), {"transaction_count": N, "total_volume": total("amount"), "avg_transaction_size": mean("amount"), "unique_cards": uniq("user_id"), "declined_transactions": hits("kind = 'error'"), "decline_rate": rate("kind = 'error'")}),
    "project_milestones": Pack("sales", ("supplier",), {"total_billable_hours": total("qty"), "total_revenue": net_total, "avg_hourly_rate": over("sum(net)", "sum(qty)"), "completed_milestones": hits("status = 'F'"), "total_milestones": N, "completion_percentage": rate("status = 'F'")}),
    "bookings_by_month": Pack("sales", ("month",), {"total_bookings": uniq("order_id"), "avg_booking_value": mean("net"), "avg_stay_duration": mean("size"), "completion_rate": rate("status = 'F'")}),
    "engagement_funnel": Pack("activity", ("day",), {"total_users": uniq("user_id"), "impressions": "count(distinct case when kind = 'view' then user_id end)", "clicks": "count(distinct case when kind = 'click' then user_id end)", "conversions": "count(distinct case when kind = 'purchase' then user_id end)",
                                                    "ctr": over("100 * count(distinct case when kind = 'click' then user_id end)", "count(distinct case when kind = 'view' then user_id end)"),
                                                    "conversion_rate": over("100 * count(distinct case when kind = 'purchase' then user_id end)", "count(distinct case when kind = 'click' then user_id end)")}),
    "customer_lifetime": Pack("sales", ("customer",), {"total_orders": uniq("order_id"), "total_spent": net_total, "first_order_date": "min(day)", "last_order_date": "max(day)", "avg_order_value": over("sum(net)", "count(distinct order_id)"), "avg_days_between_orders": GAP}),
    "vehicle_health": Pack("activity", ("user_id",), {"avg_battery_health": mean("k"), "avg_energy_consumption": mean("amount"), "total_mileage": total("amount"), "charging_sessions": hits("kind = 'click'"), "avg_charging_time": mean("case when kind = 'click' then amount end")}),
    "courier_performance": Pack("sales", ("supplier",), {"avg_delivery_time": mean("delay"), "on_time_rate": rate("delay between 0 and 60"), "total_deliveries": N, "total_tips": "round(sum(price * 0.01), 4)", "avg_tip": mean("price * 0.01")}),
    "reactions": Pack("activity", ("user_id",), {"total_reactions": N, "unique_reaction_types": uniq("kind"), "likes": hits("kind = 'click'"), "shares": hits("kind = 'purchase'"), "comments": hits("kind = 'view'"), "share_rate": rate("kind = 'purchase'")}),
    "order_delays": Pack("sales", ("priority",), {"avg_processing_time": mean("delay"), "delayed_orders": hits("delay > 60"), "total_orders": N, "delay_percentage": rate("delay > 60")}),
    "sports": Pack("activity", ("user_id",), {"avg_points": mean("amount"), "avg_rebounds": mean("k"), "avg_assists": mean("hour"), "total_points": total("amount"), "games_played": N}, rank=("team_rank", "total_points")),
    "search_queries": Pack("activity", ("k",), {"total_searches": N, "unique_users": uniq("user_id"), "click_through_rate": rate("kind = 'click'"), "avg_results": mean("amount")}),
    "review_sentiment": Pack("activity", ("k",), {"avg_rating": mean("amount"), "total_reviews": N, "positive_reviews": hits("amount >= 60"), "negative_reviews": hits("amount <= 20"), "positive_percentage": rate("amount >= 60")}),
    "feature_usage": Pack("activity", ("k",), {"usage_count": N, "avg_duration": mean("amount")}, rank=("usage_rank", "usage_count")),
    "surge_pricing": Pack("activity", ("hour",), {"total_rides": N, "avg_rating": mean("k"), "surge_rides": hits("amount > 100"), "total_earnings": total("amount")}),
    "query_performance": Pack("activity", ("kind",), {"avg_execution_time": mean("amount"), "p95_execution_time": percentile("amount", 0.95), "total_queries": N, "slow_queries": hits("amount > 100")}),
    "salary_analysis": Pack("accounts", ("nation",), {"avg_salary": mean("balance"), "median_salary": percentile("balance", 0.5), "salary_range": "round(max(balance) - min(balance), 2)", "employee_count": N}),
    "active_days": Pack("activity", ("user_id",), {"active_days": uniq("day"), "avg_session_duration": mean("amount")}),
    "spend_tiers": Pack("sales", ("customer",), {"total_spent": net_total}, tier=("customer_tier", "total_spent", ((1000000, "low"), (2500000, "medium")), "high")),
    "courier_times": Pack("sales", ("supplier", "priority"), {"avg_delivery_time": mean("delay"), "total_deliveries": N}),
    "customer_spending": Pack("sales", ("customer", "category"), {"total_spent": net_total}),
    "streamer_days": Pack("activity", ("user_id", "kind"), {"active_days": uniq("day")}),
}


def pack_sql(pack: Pack) -> str:
    """The same pack as DuckDB SQL."""
    text = {n: e.replace("percentile_approx(", "quantile_disc(").replace(", 10000)", ")") for n, e in pack.measures.items()}
    keys = ", ".join(pack.by)
    sql = f"SELECT {keys}, {', '.join(f'{e} AS {n}' for n, e in text.items())} FROM ({SOURCE_SQL[pack.source]}) s GROUP BY {keys}"
    extra = [f"{e} AS {n}" for n, e in pack.derived.items()]
    if extra:
        sql = f"SELECT *, {', '.join(extra)} FROM ({sql}) m"
    if pack.tier:
        name, measure, edges, other = pack.tier
        cases = " ".join(f"WHEN {measure} < {edge} THEN '{label}'" for edge, label in edges)
        sql = f"SELECT *, CASE {cases} ELSE '{other}' END AS {name} FROM ({sql}) m"
    if pack.rank:
        sql = f"SELECT *, rank() OVER (ORDER BY {pack.rank[1]} DESC) AS {pack.rank[0]} FROM ({sql}) m"
    return sql


def _register(name: str, pack: Pack) -> None:
    QUERIES[name] = lambda spark, folder: run(pack, SOURCES[pack.source](Tables(spark, folder)))
    ORACLES[name] = pack_sql(pack)


for _name, _pack in PACKS.items():
    _register(f"b101_{_name}", _pack)
