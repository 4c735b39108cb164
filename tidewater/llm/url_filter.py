"""URL filter: rules first, then logistic regression on hashed character n-grams. DataFrame functions only.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``,
``#`` or the end; both empty without ``://``. A rule ``host/path`` fits its host and all subdomains when the path
starts with the rule's; the longest fitting rule decides. The rules are a short list, so they are a plain
expression.

Other urls are scored by a logistic regression on ``BUCKETS`` hashed trigrams of host and path, fitted by Spark's
own trainer on a small labelled table: at most ``MAX_LABELLED`` different urls, those with the smallest hash.

Nulls, empties, ties: null urls have an empty host and path and are scored like any other. A labelled table with
one label makes that label the answer everywhere; without any label everything is allowed. A url with both labels
counts as blocked. Repeated rows are judged alike. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.shared import pick

BUCKETS = 1024
GRAM = 3
MAX_LABELLED = 4000
#: A small labelled table, written down from general knowledge of spam and of ordinary sites; no name comes from pages that are judged.
BLOCKED = """royal-casino-bonus.com/play online-casino-slots.net/spin bestcasinos.org/en/review poker-jackpot.com/lobby mega-slots-vegas.net/free lucky-roulette.com/table
sports-betting-tips.com/odds betting-bonus.org/live bingo-bonus.co.uk/join buy-viagra-online.com/order discount-pharmacy.net/rx pills4less.com/sale
no-prescription-meds.org/cart weight-loss-pills.com/offer cialis-generic.net/buy xxx-videos.com/watch hot-adult-cams.net/live sexy-dating.org/girls
adult-tube.com/videos porn-free.net/new nude-pics.org/gallery seo-backlinks.com/buy cheap-backlinks.net/packages link-farm.org/submit
spam-mailer.com/lists bulk-email-leads.net/order ad-clicks.com/redirect popup-ads.net/serve adserver.com/banner tracking-pixel.net/collect
click-tracker.com/go payday-loans-fast.com/apply cheap-loans.net/quote easy-money-now.com/signup get-rich-quick.org/secret bitcoin-doubler.com/invest
free-iphone-winner.com/claim prize-winner.net/survey cheap-rolex-replica.com/watches replica-handbags.net/shop free-download-crack.com/keygen warez-serials.net/file
miracle-diet.com/trial work-from-home-cash.net/join hot-singles.com/chat free-gift-cards.net/claim""".split()
ALLOWED = """www.university.edu/library/catalogue docs.python.org/3/tutorial en.wikipedia.org/wiki/Weather gardening.com/2021/roses
localnews.com/story weather.net/forecast www.museum.org/visit city-hall.gov/services journal.science.org/article/7 recipes.kitchen.com/es/pan
www.library.net/opening forum.cycling.org/page/12 maps.country.gov/region shop.books.com/novels radio.net/programme stackoverflow.com/questions/4
github.com/apache/spark www.bbc.co.uk/news arxiv.org/abs/1706 www.nasa.gov/missions archive.org/details/texts www.gutenberg.org/ebooks/84
www.nature.com/articles www.postgresql.org/docs developer.mozilla.org/en/docs www.debian.org/releases www.kernel.org/doc www.w3.org/TR
www.lemonde.fr/sciences www.spiegel.de/kultur elpais.com/cultura www.guardian.com/uk www.reuters.com/markets www.nytimes.com/2021/05
europa.eu/policies www.who.int/news www.un.org/en/about www.loc.gov/collections www.britannica.com/topic/physics www.nationalgeographic.com/animals
www.mit.edu/research www.ox.ac.uk/admissions www.ethz.ch/de www.sorbonne.fr/en linux.die.net/man/1 www.imdb.com/title/11
www.chess.com/lessons openstreetmap.org/node/5 www.timeanddate.com/calendar www.amazon.com/books www.ebay.com/itm/7 www.etsy.com/listing/3
hiking-club.org/trails st-johns-school.edu/staff blue-river-dental.com/hours www.smith-and-sons.co.uk/contact town-council.gov.uk/minutes long-island-news.com/local
opensource.com/article/20 lwn.net/Articles/7 www.ruby-lang.org/en/news www.r-project.org/about www.jazz-festival.org/programme green-energy.eu/projects""".split()
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest fitting rule, or null. ``rules``: rule -> allow or block."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def grams(host: Column, path: Column) -> Column:
    """Bucket of every trigram of host and path; all digits count as one."""
    def of(kind: str, s: Column) -> Column:
        marked = F.concat(F.lit("^"), F.translate(s, "123456789", "000000000"), F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - (GRAM - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(marked, i, F.lit(GRAM))), F.lit(BUCKETS)).cast("int"))

    return F.concat(of("host", host), of("path", path))


def known_urls(spark: SparkSession) -> DataFrame:
    """(url, label) of the small labelled table."""
    return spark.createDataFrame([(f"https://{u}", 1) for u in BLOCKED] + [(f"https://{u}", 0) for u in ALLOWED], "url string, label int")


def fit(labelled: DataFrame, url: str = "url", label: str = "label", max_labelled: int = MAX_LABELLED) -> tuple[list[float], float]:
    """(weights by bucket, intercept) from urls with label 1 (block) or 0 (allow)."""
    sample = pick(labelled, url=url, label=label).filter(F.col("url").isNotNull() & F.col("label").isin(0, 1)).groupBy("url").agg(F.max("label").cast("double").alias("label"))
    sample = sample.orderBy(F.xxhash64("url"), "url").limit(max_labelled)
    kinds = [r[0] for r in sample.groupBy("label").count().sort("label").collect()]
    if len(kinds) < 2:
        return [0.0] * BUCKETS, 1.0 if kinds == [1.0] else -1.0
    own = grams(host_of(F.col("url")), path_of(F.col("url")))
    counted = sample.select("url", "label", F.explode(own).alias("bucket"))
    by_url = counted.groupBy("url", "label", "bucket").count().groupBy("url", "label").agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "count"))).alias("held"), F.sum("count").alias("n"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.coalesce(F.element_at("held", i), F.lit(0)) / F.sqrt("n"))
    model = LogisticRegression(maxIter=60, regParam=0.0003, featuresCol="x").fit(by_url.select("label", array_to_vector(dense).alias("x")))
    return [float(v) for v in model.coefficients.toArray()], float(model.intercept)


def block_score(host: Column, path: Column, weights: list[float], intercept: float) -> Column:
    """Probability that a url is to be blocked."""
    table, own = F.array(*[F.lit(w) for w in weights]), grams(host, path)
    total = F.aggregate(own, F.lit(0.0), lambda s, b: s + F.get(table, b))
    return 1 / (1 + F.exp(-(F.lit(intercept) + total / F.sqrt(F.size(own)))))


def judge(pages: DataFrame, rules: dict[str, str], labelled: DataFrame | None = None, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score). ``labelled`` (url, label) is ``known_urls`` unless given."""
    base = pick(pages, page_id=page_id, url=url)
    parts = base.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parts.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    blocked = F.col("rule").isin([r for r, v in rules.items() if v == "block"])
    weights, intercept = fit(labelled if labelled is not None else known_urls(pages.sparkSession))
    scored = ruled.withColumn("score", block_score(F.col("host"), F.col("path"), weights, intercept))
    verdict = F.when(F.col("rule").isNotNull(), blocked).otherwise(F.col("score") >= 0.5)
    return scored.select("page_id", "host", "path", "rule", F.when(verdict, "block").otherwise("allow").alias("verdict"), "score")
