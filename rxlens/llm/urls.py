"""URL filters: domain rules first, then a logistic regression on hashed character n-grams.

A rule names a host and the start of a path; it fits its host and all subdomains, and the
longest fitting rule decides. Every other url is judged by a model over the character n-grams
of its host and of its path, hashed into a fixed number of buckets. An n-gram counts as its
number of occurrences over the root of the number of all n-grams, so long urls do not outweigh
short ones.

Training is batch gradient descent on the logistic loss over a small labelled table. The
weights always stay a combination of the training rows, so the descent is followed in one
coefficient per row: the products of all pairs of training rows are a small square table, and
the whole descent is one expression on it. At most ``max_rows`` labelled rows are used, those
with the smallest hashes.

All on columns: no Python on the executors, and pages are neither shuffled nor joined. The
model is ``buckets`` numbers, whatever the size of the input.

Defined results: the host runs from behind the first ``://`` to ``/``, ``?``, ``#`` or the end
and is lower-cased in A-Z alone, so a port or user name is part of it; the path follows, up to
``?``, ``#`` or the end. A null url, or one without ``://``, has an empty host and path, which
no rule fits; it is judged like any other, by the model's bias. Very long urls cost time in
proportion. Repeated rows are judged alike, extra columns are not read, an empty table gives no
rows. Labelled rows with a null url or label are left out; without both labels in the table
fitting fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlens.operators.reuse import checkpoint_stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIZES = (3, 4, 5)
BUCKETS = 1 << 13
MAX_ROWS = 400
EPOCHS = 300
RATE = 2.0
SHRINK = 1e-4
THRESHOLD = 0.6

#: (verdict, host, start of path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Words of the hosts in the small labelled table: those a crawl should leave, and should keep.
UNWANTED = """
casino royal-casino casino-slots online-casino win-casino big-win winbig jackpot-win lucky-win
free-poker poker-bets bets-today free-bet sports-bets best-bets betting free-spins free-gifts
freebies get-free cheap-meds cheap-viagra pills-online diet-pills cheappills cheap-loans
payday-loans replica-watches cheap-watches adult-video adult-chat xxx-adult adults sex-x hot-x
ads-server track-ads adtrack click-track tracker-ads banner-ads tracking spam-mail spamlinks
seo-spam link-farm content-farm farm-links crack-keygen torrent-warez click-bait
""".split()

WANTED = """
news docs library university history-museum weather gardening science-journal local-news
theatre-guide open-data city-council health-institute recipes travel-notes art-gallery
river-trust music-school there-and-then nation thinking northern other-things threads
mother-earth then-station weathering thistle three-rivers authors another theory within
attention tables anthology method fourteen the-region thousand thorn gathering rhythm
that-was-then sheath this-nation those bother thread-shop feather
""".split()


def _labelled(words: Sequence[str]) -> list[str]:
    """A url for each word; schemes, domains and paths take turns, alike for both labels."""
    made = []
    for i, word in enumerate(words):
        scheme, prefix = ("http", "https")[i % 2], ("", "www.", "m.", "blog.")[i // 2 % 4]
        domain, lang = ("com", "net", "org")[i % 3], ("en", "fr", "de", "es")[i // 3 % 4]
        tail = ("", "/", ".html", "#top", "?page=2&ref=x", "?utm_source=feed")[i // 4 % 6]
        made.append(f"{scheme}://{prefix}{word}.example.{domain}/{lang}/{i * 37 % 1000}{tail}")
    return made


@dataclass(frozen=True)
class UrlModel:
    """``weights`` by bucket; the last one is the bias."""

    weights: tuple[float, ...]
    sizes: tuple[int, ...]

    @property
    def buckets(self) -> int:
        return len(self.weights) - 1


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, empty where there are none."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    pattern = "://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), UPPER, UPPER.lower())
    return host, F.regexp_extract(url, pattern, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest rule that fits, else null.

    Of rules that are spelled the same the first in the sequence holds.
    """
    found = None
    for verdict, at, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == at) | F.endswith(host, F.lit(f".{at}"))) & F.startswith(path, F.lit(start))
        value = F.struct(F.lit(f"{at}{start}").alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if found is None else found


def grams(part: Column, tag: str, sizes: Sequence[int]) -> Column:
    """All n-grams of a text between two boundary marks, as an array of tagged strings.

    Each length is the array of single characters laid beside itself, shifted by one more
    place: work in proportion to the text, without looking up places in it.
    """
    chars = F.split(F.concat(F.lit("\x02"), F.lower(part), F.lit("\x03")), "")
    lists, run = [], chars
    for size in range(2, max(sizes) + 1):
        shifted = F.slice(chars, size, F.greatest(F.size(chars) - (size - 1), F.lit(0)))
        run = F.filter(F.zip_with(run, shifted, lambda a, b: F.concat(a, b)), lambda g: g.isNotNull())
        if size in sizes:
            lists.append(F.transform(run, lambda g: F.concat(F.lit(tag), g)))
    return F.concat(*lists)


def _buckets(host: Column, path: Column, sizes: Sequence[int], buckets: int) -> Column:
    every = F.concat(grams(host, "h", sizes), grams(path, "p", sizes))
    return F.transform(every, lambda g: F.pmod(F.xxhash64(g), F.lit(buckets)).cast("int"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table above: ``url`` and ``unwanted``."""

    def rows(urls: Sequence[str], unwanted: bool) -> DataFrame:
        url = F.explode(F.split(F.lit("\n".join(urls)), "\n"))
        return spark.range(1).select(url.alias("url"), F.lit(unwanted).alias("unwanted"))

    return rows(_labelled(UNWANTED), True).union(rows(_labelled(WANTED), False))


def fit(
    labelled: DataFrame,
    sizes: Sequence[int] = SIZES,
    buckets: int = BUCKETS,
    max_rows: int = MAX_ROWS,
    epochs: int = EPOCHS,
    rate: float = RATE,
    shrink: float = SHRINK,
) -> UrlModel:
    """Train on ``url`` and ``unwanted``; both labels weigh the same in total."""
    rows = labelled.select(F.col("url").cast("string").alias("url"), F.col("unwanted").cast("boolean"))
    rows = rows.filter("url is not null and unwanted is not null").distinct()
    rows = rows.orderBy(F.xxhash64("url", "unwanted"), "url", "unwanted").limit(max_rows)
    host, path = url_parts(F.col("url"))
    known = rows.select("url", "unwanted", _buckets(host, path, sizes, buckets).alias("ids"))
    key = F.struct("unwanted", "url").alias("row")
    bits = known.select(key, F.size("ids").alias("n"), F.explode("ids").alias("bucket"))
    x = bits.groupBy("row", "bucket").agg((F.count("*") / F.sqrt(F.first("n"))).alias("x"))
    bias = known.select(key, F.lit(buckets).alias("bucket"), F.lit(1.0).alias("x"))
    x = checkpoint_stage(x.union(bias))
    other = x.select(F.col("row").alias("other"), "bucket", F.col("x").alias("y"))
    # The bias belongs to every row, so every pair has a product.
    products = x.join(other, "bucket").groupBy("row", "other").agg(F.sum(F.expr("x * y")).alias("k"))
    lines = products.groupBy("row").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("other", "k"))), lambda p: p["k"]).alias("k")
    )
    table = lines.agg(F.sort_array(F.collect_list(F.struct("row", "k"))).alias("rows"))
    size, wanted = F.size("rows"), F.size(F.filter("rows", lambda r: ~r["row"]["unwanted"]))
    table = table.select("rows", size.alias("n"), wanted.alias("n0"), (size - wanted).alias("n1"))

    def descend(coefficients: Column, _: Column) -> Column:
        def step(a: Column, row: Column) -> Column:
            products = F.zip_with(row["k"], coefficients, lambda k, c: k * c)
            margin = F.aggregate(products, F.lit(0.0), lambda total, v: total + v)
            hit = row["row"]["unwanted"]
            share = F.when(hit, 0.5 / F.col("n1")).otherwise(0.5 / F.col("n0"))
            error = 1 / (1 + F.exp(-margin)) - hit.cast("double")
            return a - rate * (error * share + shrink * a)

        return F.zip_with(coefficients, F.col("rows"), step)

    start = F.transform("rows", lambda _: F.lit(0.0))
    trained = F.aggregate(F.sequence(F.lit(1), F.lit(epochs)), start, descend)
    ends = table.select(F.explode(F.arrays_zip("rows", trained.alias("a"))).alias("t"))
    ends = ends.select(F.col("t.rows.row").alias("row"), F.col("t.a").alias("a"))
    summed = x.join(ends, "row").groupBy("bucket").agg(F.round(F.sum(F.expr("a * x")), 6).alias("w"))
    weights = [0.0] * (buckets + 1)
    for r in summed.collect():  # at most one row per bucket
        weights[r["bucket"]] = r["w"]
    labels = {r[0] for r in x.select("row.unwanted").distinct().collect()}
    if labels != {True, False}:
        raise ValueError("the labelled table needs urls of both labels")
    return UrlModel(tuple(weights), tuple(sizes))


def score(host: Column, path: Column, model: UrlModel) -> Column:
    """Probability that a url is unwanted."""
    # One literal: an array of numbers folded from its text when the plan is made.
    weights = F.split(F.lit(",".join(map(repr, model.weights[:-1]))), ",").cast("array<double>")
    ids = _buckets(host, path, model.sizes, model.buckets)
    packed = F.aggregate(
        ids,
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
        lambda t, i: F.struct((t["sum"] + F.get(weights, i)).alias("sum"), (t["n"] + 1).alias("n")),
        lambda t: t["sum"] / F.sqrt(F.greatest(t["n"], F.lit(1))),
    )
    return 1 / (1 + F.exp(-(packed + model.weights[-1])))


def judge(
    pages: DataFrame,
    model: UrlModel,
    rules: Sequence[tuple[str, str, str]] = RULES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every url.

    ``score`` is worked out for urls without a rule alone, and null for the others.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = parts.withColumn("by", rule_of(F.col("host"), F.col("path"), rules))
    free = F.col("by").isNull()
    ruled = ruled.withColumn("score", F.when(free, score(F.col("host"), F.col("path"), model)))
    guess = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return ruled.select(
        "page_id",
        "host",
        "path",
        F.col("by.rule").alias("rule"),
        F.coalesce(F.col("by.verdict"), guess).alias("verdict"),
        "score",
    )


def url_report(pages: DataFrame) -> DataFrame:
    """The query's rows."""
    return judge(pages, fit(labelled_urls(pages.sparkSession)))
