"""URL filter: rules first, then a logistic regression on hashed character n-grams.

Everything runs as DataFrame expressions.  A URL's features are the distinct
hashed character n-grams of host and path, scaled to length one.  The model is
fitted on a small labelled table in the kernel form of regularised logistic
regression: one row holds the table's Gram matrix, and gradient descent on its
coefficients is a fold over that row, so training is a single small job.  The
coefficients become `BUCKETS` weights, a literal in the scoring expression.

Edge cases.  A null URL or one without `://` has an empty host and path; no
rule fits it and the model judges it by its intercept.  Repeated rows are
judged each.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4096
GRAMS = (3, 4)
STEPS, RATE, DECAY = 500, 2.0, 0.0005
#: Rules up to this number become one expression; more are joined by host suffix.
FEW_RULES = 64

#: Rules (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

#: Labelled URLs, 1 to block: adult, gambling, spam, advertising, downloads, log-in and search pages against prose pages.
_BLOCK = """
http://casino-bonus.example.com/free-spins http://www.poker-slots.example.net/jackpot/win http://bet365-odds.example.com/casino/live http://xxx-videos.example.net/adult/teen
https://porn.example.com/sex/hd http://adult-cams.example.net/xxx/live https://sex-dating.example.org/adult/chat http://viagra-pills.example.com/buy/cheap
http://cheap-pharmacy.example.net/pills/order https://buy-cialis.example.com/cheap/pills https://ads.example.com/click?id=1 http://adserver.example.net/banner/track
https://track.example.com/pixel/click http://doubleclick.example.net/ads/banner https://example.com/login http://www.example.net/user/signup
https://example.org/cart/checkout http://shop.example.com/cart/add https://example.net/account/password http://example.com/wp-login.php
https://torrent.example.net/download/crack http://warez.example.com/keygen/crack https://free-download.example.net/setup.exe http://files.example.com/torrent/movie.zip
https://win-prize.example.com/free/iphone http://lottery-winner.example.net/prize/claim https://crypto-doubler.example.com/bitcoin/profit http://forex-profit.example.net/earn/money
http://earn-cash.example.com/money/fast https://payday-loans.example.net/loan/apply http://spam.example.com/seo/backlinks https://cheap-seo.example.net/backlinks/buy
http://replica-watches.example.com/buy/rolex https://example.com/search?q=a http://www.example.net/search/results https://example.org/tag/casino
http://hot-singles.example.com/dating/sex https://slots.example.org/casino/bonus http://example.net/affiliate/click http://popup.example.com/ads/redirect
http://quick-loans.example.com/loan/apply https://mega-jackpot.example.net/slots/free http://sponsor.example.com/click/ad https://mail.example.net/signin
""".split()
_ALLOW = """
https://www.example.com/en/1204.html https://blog.example.net/en/3381 http://m.example.org/fr/92/ https://news.example.com/de/551?page=2
https://blog.example.com/es/8127#top http://www.example.net/en/77 https://texts.example.net/en/40021.html https://press.example.com/en/15/
https://en.wiki.example.org/wiki/History https://docs.example.com/guide/install http://www.example.edu/research/paper https://news.example.net/2019/05/science
https://www.example.org/articles/climate https://blog.example.com/posts/gardening http://library.example.edu/books/chapter https://example.org/essay/music
https://journal.example.net/volume/12/article http://museum.example.org/collection/history https://example.net/recipes/bread https://weather.example.com/report/north
https://www.example.com/culture/theatre-review http://school.example.edu/lessons/maths https://handbook.example.org/chapter/3 https://example.com/stories/the-river
http://archive.example.net/letters/1871 https://health.example.org/topics/sleep http://city.example.com/council/minutes https://example.net/fr/histoire/ville
https://example.com/de/artikel/wald http://example.org/es/noticias/mar https://m.example.net/de/13001.html https://www.example.net/es/9120/
https://site.example.net/fr/6204?utm_source=feed http://pages.example.com/en/210 https://daily.example.net/en/99874#top https://blog.example.org/de/4711
https://radio.example.org/programmes/talk http://forum.example.edu/threads/grammar https://example.net/poems/winter https://encyclopedia.example.com/entry/whale
https://m.theatre.example.net/en/5120.html http://www.thorntons.example.net/de/8811 https://m.hatter.example.net/es/613 https://cooking.example.com/recipes/stew
http://blog.theatre.example.net/fr/42?page=2 https://m.thatcher.example.com/en/7001/ http://www.there-and-then.example.net/en/310#top https://stones.example.com/es/88.html
""".split()
LABELLED = tuple((u, 1) for u in _BLOCK) + tuple((u, 0) for u in _ALLOW)


def _after(url: Column) -> Column:
    """What follows the first ://; null without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(_after(url), "^([^/?#]*)", 1), F.lit("")), upper, upper.lower())


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def features(host_: Column, path_: Column) -> Column:
    """Distinct hashed n-grams of host and path, each marked at its ends."""
    text = F.concat(F.lit("^"), host_, F.lit("|"), F.lower(path_), F.lit("$"))

    def grams(n: int) -> Column:  # a lambda of two parameters would get the place as its second
        hashed = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.pmod(F.hash(F.substr(text, i, F.lit(n))), F.lit(BUCKETS)))
        return F.when(F.length(text) >= n, hashed).otherwise(F.array().cast("array<int>"))

    return F.array_distinct(F.concat(*[grams(n) for n in GRAMS]))


class Model:
    def __init__(self, weights: list[float], intercept: float):
        self.weights, self.intercept = weights, intercept

    def score(self, found: Column) -> Column:
        """Probability of 1 (block) for a column of features."""
        table = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        total = F.aggregate(found, F.lit(0.0), lambda acc, i: acc + F.get(table, i))
        return 1 / (1 + F.exp(-(F.lit(self.intercept) + total / F.sqrt(F.greatest(F.size(found), F.lit(1))))))


def train(spark: SparkSession, labelled: tuple[tuple[str, int], ...] = LABELLED) -> Model:
    """Fit on a small table of (url, 0 or 1); its rows are the only ones that meet in one place."""
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(u).alias("url"), F.lit(y).alias("y")) for k, (u, y) in enumerate(labelled)])
    rows = spark.range(1).select(F.inline(table)).select("k", F.col("y").cast("double").alias("y"), features(host(F.col("url")), path(F.col("url"))).alias("x"))
    one = rows.agg(F.array_sort(F.collect_list(F.struct("k", "y", "x"))).alias("t"))
    gram = "transform(t, a -> transform(t, b -> size(array_intersect(a.x, b.x)) / sqrt(size(a.x) * size(b.x))))"
    # coefficients c and intercept b move by the residual of each row; the intercept is not decayed
    step = f"""(s, i) -> named_struct(
        'c', transform(s.c, (v, k) -> v * (1 - {RATE} * {DECAY}) + {RATE} * r(s, k)),
        'b', s.b + {RATE} * aggregate(sequence(0, size(t) - 1), 0D, (acc, k) -> acc + r(s, k)) / size(t))"""
    step = step.replace("r(s, k)", "(t[k].y - 1 / (1 + exp(-(s.b + aggregate(zip_with(g[k], s.c, (u, v) -> u * v), 0D, (acc, v) -> acc + v)))))")
    fitted = one.withColumn("g", F.expr(gram)).select("t", F.expr(f"aggregate(sequence(1, {STEPS}), named_struct('c', transform(t, a -> 0D), 'b', 0D), {step})").alias("s"))
    terms = fitted.select(F.col("s.b").alias("b"), F.explode(F.expr("zip_with(t, s.c, (a, v) -> struct(a.x as x, v / sqrt(size(a.x)) as v))")).alias("e")).select("b", F.explode("e.x").alias("i"), F.col("e.v").alias("v"))
    weights, b = [0.0] * BUCKETS, 0.0
    for r in terms.groupBy("b", "i").agg(F.sum("v").alias("v")).collect():  # at most BUCKETS rows
        weights[r["i"]], b = float(r["v"]), float(r["b"])
    return Model(weights, b)


def apply_rules(df: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """`df` (host, path) with rule and rule_verdict of the longest rule that fits; null where none does."""
    if len(rules) > FEW_RULES:
        return _joined_rules(df, rules)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, _, p = text.partition("/")
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(f"/{p}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(name)).otherwise(verdict)
    return df.withColumns({"rule": rule, "rule_verdict": verdict})


def _joined_rules(df: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    """The same by a join: rules are grouped by host, hosts are looked up once each with all their suffixes."""
    spark = df.sparkSession
    table = spark.createDataFrame([(t.partition("/")[0], "/" + t.partition("/")[2], t, v) for v, t in rules], "rule_host string, p string, t string, v string")
    grouped = table.groupBy("rule_host").agg(F.collect_list(F.struct("p", "t", "v")).alias("own"))
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = df.select("host").distinct().withColumn("rule_host", F.explode(suffixes)).join(grouped, "rule_host").groupBy("host").agg(F.flatten(F.collect_list("own")).alias("_own"))
    fits = F.filter("_own", lambda r: F.col("path").startswith(r["p"]))
    best = F.element_at(F.array_sort(F.transform(fits, lambda r: F.struct(F.length(r["t"]).alias("n"), r["t"].alias("t"), r["v"].alias("v")))), -1)
    joined = df.join(hosts, "host", "left").withColumn("_best", F.when(F.size(F.coalesce(fits, F.array())) > 0, best))
    return joined.withColumns({"rule": F.col("_best.t"), "rule_verdict": F.col("_best.v")}).drop("_own", "_best")


def judge(pages: DataFrame, model: Model | None = None, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row of `pages` (page_id, url)."""
    model = model or train(pages.sparkSession)
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    scored = apply_rules(parts, rules).withColumn("score", model.score(features(F.col("host"), F.col("path"))))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "score")
