"""URL filter: host and path rules, then logistic regression on hashed character n-grams. DataFrame functions only.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case. Path: then up to
``?``, ``#`` or the end. Null or no ``://``: both empty. The longest rule that fits decides; else the model does.

The model's features are the distinct hashed 3- to 5-grams of host and path, of unit length as a vector. It is
trained by gradient descent in its dual form: a weight per labelled URL over their Gram matrix, a small array
that one expression folds over all steps. The labelled table must stay small (``most`` rows, an error beyond).
Every row gives one row, also repeated ones; extra columns are ignored. An empty URL has no features and gets
the sign of the constant.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS, STEPS, RATE, DECAY = 1 << 13, 300, 2.0, 1e-3
#: Lengths of n-grams, and the base of their polynomial hash over code points.
SIZES, BASE = (3, 4, 5), 131

#: (host and path of the rule, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))

# The labelled table: kinds of names, fixed values of our own. Each name is put into one of the FRAMES by its place, so
# that both labels see the same schemes, subdomains, domains and paths. No name, domain or path is taken from a table
# that the filter judges.
BLOCKED = {
    "gambling": "poker-room slots-jackpot roulette-online blackjack-live betting-tips sportsbook-odds lotto-winner casinoroyale online-casinos casino-games bingo-bonus betonline livebets",
    "pharmacy": "viagra-online cialis-discount pharmacy-direct buy-xanax diet-pills pillstore discount-meds cheapviagra no-prescription steroids-shop cheap-drugs",
    "adult": "xxx-videos porn-tube sex-cams adult-chat escort-girls nude-pics adultdating hotmilfs webcam-sex adult-toys x-movies",
    "money": "payday-loans quick-cash easy-money bad-credit-loan forex-signals get-rich-fast cash-advance crypto-doubler free-money win-money",
    "advertising": "ad-server ads-network click-tracker banner-ads popup-ads pixel-tracking adclicks tracker-cdn affiliate-clicks trackads adserve",
    "links": "link-farm cheap-backlinks seo-links spam-blog doorway-pages article-spinner linkfarms spammer buy-links spamsite",
    "swindles": "free-iphone free-giftcards win-prize you-won replica-watches fake-rolex warez-crack keygen-serial miracle-cure lose-weight-fast winner-prizes",
}
ALLOWED = {
    "learning": "university library school-district kindergarten biologia matematicas literature philosophy mathematics engineering thesis education history-faculty physics astronomy theology anthropology",
    "news": "newspaper telegraph tribune herald gazette chronicle observer noticias zeitung public-radio television weather-report meteo tageblatt courrier",
    "culture": "science-museum city-theatre orchestra nationaltheater book-review architecture photography cathedral heritage chess-club music-academy poetry-foundation filmarchiv bibliotheque",
    "places": "town-hall ayuntamiento mairie council north-coast old-bridge river-walk lighthouse harbour village mountain-valley island castle bahnhof railway south-station",
    "trades": "bakery brewery vineyard orchard boulangerie farmers-market leatherworks stationers gardening cuisine recetas carpenters feuerwehr hospital tithebarn smithery",
    "nature": "forest lakes birdwatch botanik geologie conservation wanderung thermal-springs meadow thicket heather rhododendron weatherstation northern-birds",
    "society": "gathering brotherhood mother-and-child translation stamp-collectors travel-guide athletics open-source volunteers neighbours theseus thorough together three-rivers other-worlds",
}
FRAMES = tuple(f"{scheme}://{sub}{{}}.{domain}{path}" for scheme, sub, domain, path in (
    ("http", "", "info", "/about"), ("https", "www.", "co.uk", "/news/2021/03/item"), ("http", "my.", "io", "/a/b/c"), ("https", "shop.", "eu", "/list?sort=up"), ("https", "", "co.uk", "/"),
    ("http", "www.", "info", "/index.php"), ("https", "my.", "eu", "/p/7718"), ("http", "shop.", "io", ""), ("https", "", "eu", "/start.htm#main"), ("http", "www.", "io", "/contact/"), ("https", "my.", "info", "/2020"),
))


def names(label: int) -> list[tuple[str, str]]:
    """(kind, name) of the names to block (1) or to allow (0)."""
    return [(kind, name) for kind, listed in (BLOCKED if label else ALLOWED).items() for name in listed.split()]


def urls(label: int) -> list[str]:
    return [FRAMES[k % len(FRAMES)].format(name) for k, (_, name) in enumerate(names(label))]


def labelled(spark: SparkSession) -> DataFrame:
    """(url, label): the small table the filter ships with."""
    rows = ", ".join(f"('{u}', {y})" for y in (1, 0) for u in urls(y))
    return spark.sql(f"SELECT col1 AS url, col2 AS label FROM VALUES {rows}")


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host, path = (F.regexp_extract(rest, r"(?s)^([^/?#]*)([^?#]*)", k) for k in (1, 2))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def grams(host: Column, path: Column, buckets: int) -> Column:
    """The distinct hashed n-grams of host and path; the host is marked at both ends.

    The text becomes an array of code points once, so that n-grams of long URLs take time in proportion to their length.
    """
    text = F.concat(F.lit("^"), host, F.lit("$"), path)
    codes = F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda c: F.ascii(c).cast("long"))

    def hashed(c: Column, n: int) -> Column:
        value = lambda i: reduce(lambda s, j: s * BASE + F.get(c, i + j), range(n), F.lit(n).cast("long"))
        return F.when(F.size(c) >= n, F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: (value(i) % buckets).cast("int"))).otherwise(F.array().cast("array<int>"))

    # a lambda over the one array holds its value
    found = F.get(F.transform(F.array(codes), lambda c: F.array_distinct(F.concat(*(hashed(c, n) for n in SIZES)))), F.lit(0))
    return F.when(F.length(host) + F.length(path) > 0, found).otherwise(F.array().cast("array<int>"))


def fit(table: DataFrame, buckets: int = BUCKETS, steps: int = STEPS, rate: float = RATE, decay: float = DECAY, most: int = 1000) -> tuple[float, list[float]]:
    """The constant and the weight of each bucket, from (url, label) rows; label 1 means block. Null labels are left out."""
    rows = table.select(F.col("url"), F.col("label").cast("double").alias("label")).filter("label is not null").distinct()
    rows = rows.select("label", grams(*host_path(F.col("url")), buckets).alias("b"), F.xxhash64("url").alias("id"))
    n = rows.count()
    if not 0 < n <= most:
        raise ValueError(f"the labelled table has {n} rows; 1 to {most} are asked for")
    whole = rows.groupBy().agg(F.array_sort(F.collect_list(F.struct("id", "label", "b"))).alias("r"))
    scale = lambda x: F.sqrt(F.greatest(F.size(x.b), F.lit(1)).cast("double"))
    # gathered again, so that the fold reads the Gram matrix instead of making it in every step
    row = F.transform("r", lambda y: F.size(F.array_intersect(F.col("x.b"), y.b)) / (scale(F.col("x")) * scale(y)) + 1.0)
    gram = whole.select(F.posexplode("r").alias("i", "x"), "r").select("i", F.col("x.label").alias("label"), row.alias("row"))
    gram = gram.groupBy().agg(F.array_sort(F.collect_list(F.struct("i", "label", "row"))).alias("k"))

    def step(a: Column, _: Column) -> Column:
        dot = lambda i: F.aggregate(F.zip_with(F.col("k")[i].row, a, lambda p, q: p * q), F.lit(0.0), lambda s, x: s + x)
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: a[i] * (1 - rate * decay) + rate / n * (F.col("k")[i].label - 1 / (1 + F.exp(-dot(i)))))

    solved = gram.select(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.array_repeat(F.lit(0.0), n), step)).first()[0]
    constant = math.fsum(solved)
    dual = F.split(F.lit(",".join(map(repr, solved))), ",").cast("array<double>")
    each = whole.select(F.posexplode("r").alias("i", "x")).select(F.get(dual, F.col("i")).alias("a"), F.col("x.b").alias("b"))
    weights = [0.0] * buckets
    for b, w in each.select(F.explode("b").alias("bucket"), (F.col("a") / F.sqrt(F.size("b").cast("double"))).alias("w")).groupBy("bucket").agg(F.sum("w")).collect():
        weights[b] = w
    return constant, weights


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, what in sorted(rules, key=lambda r: len(r[0])):
        at, slash, under = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + under)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, table: DataFrame | None = None, rules: tuple[tuple[str, str], ...] = RULES, buckets: int = BUCKETS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (the model's log-odds of block)."""
    constant, weights = fit(labelled(pages.sparkSession) if table is None else table, buckets)
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"))
    host, path = host_path(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("b", grams(F.col("host"), F.col("path"), buckets))
    score = F.lit(constant) + F.aggregate("b", F.lit(0.0), lambda s, b: s + F.get(w, b)) / F.sqrt(F.greatest(F.size("b"), F.lit(1)).cast("double"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("v"), score.alias("score"))
    return rows.select("page_id", "host", "path", "rule", F.coalesce("v", F.when(F.col("score") >= 0, "block").otherwise("allow")).alias("verdict"), F.round("score", 4).alias("score"))


def oracle_sql(buckets: int = BUCKETS, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> str:
    """The same in DuckDB SQL, training included, without the score."""
    values = ", ".join(f"('{u}', {y})" for y in (1, 0) for u in urls(y))
    split = r"""SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
FROM (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM {})"""
    value = lambda n: reduce(lambda e, j: f"({e} * {BASE} + unicode(t[i+{j}:i+{j}]))", range(n), f"{n}::BIGINT")
    lists = " || ".join(f"[{value(n)} % {buckets} FOR i IN range(1, len(t) - {n - 2})]" for n in SIZES)
    gram = f"""SELECT *, CASE WHEN host || path = '' THEN [] ELSE list_sort(list_distinct({lists})) END AS b
FROM (SELECT *, '^' || host || '$' || path AS t FROM ({split}))"""
    cases = lambda what: " ".join(f"WHEN (host = '{a}' OR host LIKE '%.{a}') AND path LIKE '/{u}%' THEN '{what(r, v)}'" for r, v in sorted(RULES, key=lambda r: -len(r[0])) for a, _, u in [r.partition("/")])
    return f"""
WITH RECURSIVE t(url, label) AS (VALUES {values}),
l AS (SELECT row_number() OVER (ORDER BY url) AS id, label, b, sqrt(greatest(len(b), 1)) AS s FROM ({gram.format("t")})),
k AS (SELECT x.id, x.label::DOUBLE AS label, list(len(list_intersect(x.b, y.b)) / (x.s * y.s) + 1.0 ORDER BY y.id) AS row FROM l x, l y GROUP BY x.id, x.label),
m AS (SELECT list(row ORDER BY id) AS k, list(label ORDER BY id) AS y, count(*) AS n FROM k),
it(step, a) AS (
  SELECT 0, list_transform(range(n), lambda i: 0.0::DOUBLE) FROM m
  UNION ALL
  SELECT step + 1, list_transform(range(1, n + 1), lambda i: a[i] * (1 - {rate} * {decay}) + {rate} / n * (y[i] - 1 / (1 + exp(-list_dot_product(k[i], a))))) FROM it, m WHERE step < {steps}),
alpha AS (SELECT unnest(range(1, len(a) + 1)) AS id, unnest(a) AS a FROM it WHERE step = {steps}),
w AS (SELECT bucket, sum(a / s) AS w FROM (SELECT a, s, unnest(b) AS bucket FROM alpha JOIN l USING (id)) GROUP BY bucket),
p AS ({gram.format("pages")}),
g AS (SELECT page_id, sum(w) / any_value(sqrt(len(b))) AS z FROM (SELECT page_id, b, unnest(b) AS bucket FROM p) JOIN w USING (bucket) GROUP BY page_id)
SELECT page_id, host, path, CASE {cases(lambda r, v: r)} END AS rule,
CASE {cases(lambda r, v: v)} WHEN (SELECT sum(a) FROM alpha) + coalesce(z, 0) >= 0 THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN g USING (page_id)
"""
