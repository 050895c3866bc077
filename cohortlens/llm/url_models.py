"""URL filter by the ratio of two character language models (operator 11).

Rules of host and path allow or block some urls (the longest that fits wins). The urls that a rule allows and those that
a rule blocks train one variable-order Markov model of characters each: every context of up to ``ORDER`` characters that
its class has seen at least ``MIN_SEEN`` times predicts the next character, smoothed towards the context one character
shorter after Witten and Bell, down to an even chance for all code points; rarer contexts are passed over. The score of a
url is the difference of its two log-likelihoods divided by its number of characters (the end counts as one), in
thousandths of a nat, and urls that no rule judges are blocked if their score is below the limit. The limit is the one
with the least balanced error on judged urls that were kept out of training (those whose MD5 begins with 0, 1 or 2).

All of it is DataFrame work. Every distinct url counts once, however many rows repeat it. Its windows of ``ORDER`` + 1
characters are counted with map-side partial sums; the shorter n-grams are sums of the distinct windows; a context has at
most one row for each character that follows it. Scores come from joining the windows of the urls to their weights, which
grow with the input and are never gathered in one place: the windows that hold a ten-thousandth or more of all positions
(so ten thousand at most) are broadcast, all others meet by a sort-merge join in which no key is frequent. The verdicts
return to the rows by url in the same way. Weights are rounded to integers, so sums don't depend on the order of rows.

Defined cases: a url is judged by its text after the first ``://`` with the host in lower case (A-Z only), or by the whole
text where that is missing; a null url counts as an empty one, of which the model sees only the end; a class without any
url predicts all characters evenly, and without held-out urls of both classes the limit is 0; equal urls get equal
verdicts; null and repeated page_ids stay as they are; an empty table gives no rows; columns other than page_id and url
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.shared import stored

ORDER, MIN_SEEN = 5, 4
#: Keys with this share of all rows or more are joined by broadcast: at most 1 / share of them exist.
HOT_SHARE = 10_000
CODE_POINTS = 1_114_112
OPEN, END = "\x01", "\x02"
CHUNK = 256
HELD_OUT = ["0", "1", "2"]
#: Fixed values of the contract: (verdict, host and path).
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, the text that the models see)."""
    whole = F.coalesce(url, F.lit(""))
    cut = F.locate("://", whole)
    rest = F.when(cut > 0, F.substr(whole, cut + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    behind = F.substr(rest, F.length(host) + 1)
    low = F.translate(host, _UPPER, _LOWER)
    return low, F.regexp_extract(behind, "^[^?#]*", 0), F.when(cut > 0, F.concat(low, behind)).otherwise(whole)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _windows(urls: DataFrame, order: int) -> DataFrame:
    """The columns of ``urls`` without its text, one row for each character of it and one for its end, with the window of
    the ``order`` characters before it and itself. Long texts are cut first: a substring is sought from its beginning."""
    padded = F.concat(F.lit(OPEN * order), F.col("text"), F.lit(END))
    others = [c for c in urls.columns if c != "text"]
    chunks = urls.select(*others, F.explode(F.transform(
        F.sequence(F.lit(0), F.floor(F.length("text") / CHUNK)),
        lambda c: F.substr(padded, c.cast("int") * CHUNK + 1, F.lit(CHUNK + order)))).alias("chunk"))
    return chunks.where(F.length("chunk") > order).select(*others, F.explode(F.transform(
        F.sequence(F.lit(1), F.length("chunk") - order),
        lambda p: F.substr(F.col("chunk"), p.cast("int"), F.lit(order + 1)))).alias("window"))


def train(urls: DataFrame, order: int = ORDER, min_seen: int = MIN_SEEN) -> DataFrame:
    """window, weight (1000 times the log of the ratio of its last character's probabilities), uses. ``urls`` has text,
    ``accepted`` and ``rejected`` (it trains that model) and ``used`` (it will be scored), all but text booleans."""
    marked = urls.select("text", *[F.col(c).cast("long").alias(c) for c in ("accepted", "rejected", "used")])
    counts = stored(_windows(marked, order).groupBy("window").agg(
        F.sum("accepted").alias("n_a"), F.sum("rejected").alias("n_r"), F.sum("used").alias("uses")), "windows")
    lower = None
    for k in range(order + 1):
        grams = counts.select(F.substr("window", F.lit(order + 1 - k)).alias("gram"), "n_a", "n_r", "uses")
        if k < order:
            grams = grams.groupBy("gram").agg(F.sum("n_a").alias("n_a"), F.sum("n_r").alias("n_r"))
        same = Window.partitionBy(F.substr("gram", F.lit(1), F.lit(k)))
        for c in "ar":
            grams = grams.withColumns({f"all_{c}": F.sum(f"n_{c}").over(same),
                                       f"kinds_{c}": F.sum((F.col(f"n_{c}") > 0).cast("long")).over(same)})
        if lower is None:
            even = F.lit(1.0) / F.lit(float(CODE_POINTS))
            p = {c: (F.col(f"n_{c}") + (F.col(f"kinds_{c}") + 1) * even) / (F.col(f"all_{c}") + F.col(f"kinds_{c}") + 1) for c in "ar"}
        else:
            grams = grams.withColumn("shorter", F.substr("gram", F.lit(2))).join(lower, "shorter")
            p = {c: F.when(F.col(f"all_{c}") >= min_seen, (F.col(f"n_{c}") + F.col(f"kinds_{c}") * F.col(f"low_{c}"))
                           / (F.col(f"all_{c}") + F.col(f"kinds_{c}"))).otherwise(F.col(f"low_{c}")) for c in "ar"}
        lower = grams.select(F.col("gram").alias("shorter"), p["a"].alias("low_a"), p["r"].alias("low_r"),
                             *(["uses"] if k == order else []))
    weight = F.floor(F.lit(1000.0) * F.ln(F.col("low_a") / F.col("low_r")) + 0.5).cast("long")
    return lower.select(F.col("shorter").alias("window"), weight.alias("weight"), "uses")


def _with_frequent(rows: DataFrame, values: DataFrame, key: str, uses: str, share: int = HOT_SHARE) -> DataFrame:
    """``rows`` joined to stored ``values`` (one row for each ``key``, ``uses``: how many rows have it). Keys with 1 / ``share``
    of the rows or more, at most ``share`` of them, are broadcast; the others have few rows each and are merged."""
    total = values.agg(F.sum(uses)).first()[0] or 0
    frequent = F.col(uses) * share >= total
    hot = F.broadcast(values.where(frequent).drop(uses))
    cold = values.where(~frequent).drop(uses)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold.hint("merge"), key))


def score(urls: DataFrame, weights: DataFrame, order: int = ORDER) -> DataFrame:
    """url and its score for the rows of ``urls`` (url, text), all of whose windows have stored ``weights``."""
    parts = _with_frequent(_windows(urls.select("url", "text"), order), weights, "window", "uses")
    sums = parts.groupBy("url").agg(F.sum("weight").alias("total"), F.count("*").alias("chars"))
    far = 10**9  # division that rounds down on negative totals too
    return sums.select("url", F.expr(f"(total + {far} * chars) div chars - {far}").alias("score"))


def calibrate(scores: DataFrame) -> int:
    """The limit with the least balanced error on ``scores`` (score, accepted): the shares of accepted ones below it and
    of others not below it. Ties go to the limit nearest 0, then the smallest; 0 where a class is missing.

    Scores are integers within about +-25,000, so their histogram has a bounded number of rows."""
    one = F.lit(1).cast("long")
    seen = scores.select("score", F.when(F.col("accepted"), one).otherwise(0).alias("a"), F.when(F.col("accepted"), 0).otherwise(one).alias("r"))
    zero = scores.sparkSession.range(1).select(F.lit(0).cast("long").alias("score"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("r"))
    bins = seen.unionByName(zero).groupBy("score").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    every = Window.orderBy("score")
    upto = bins.select("score", (F.sum("a").over(every) - F.col("a")).alias("a_below"), (F.sum("r").over(every) - F.col("r")).alias("r_below"),
                       F.sum("a").over(Window.partitionBy()).alias("all_a"), F.sum("r").over(Window.partitionBy()).alias("all_r"))
    error = F.col("a_below") * F.col("all_r") + (F.col("all_r") - F.col("r_below")) * F.col("all_a")
    best = upto.where("all_a > 0 and all_r > 0").select("score", error.alias("error")).orderBy("error", F.abs("score"), "score").first()
    return best["score"] if best else 0


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, order: int = ORDER, min_seen: int = MIN_SEEN,
          share: int = HOT_SHARE) -> DataFrame:
    """page_id, host, path, rule, verdict, and for urls without a rule their score and the limit, for all pages."""
    host, path, text = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parsed = rows.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "verdict": verdict})

    each = rows.groupBy("url").agg(F.count("*").alias("n"))
    held = F.substr(F.md5(F.col("url").cast("binary")), F.lit(1), F.lit(1)).isin(HELD_OUT)
    each = each.withColumns({"host": host, "path": path, "text": text}).withColumn("verdict", verdict)
    urls = stored(each.select("url", "n", "text", "verdict", held.alias("held"),
                              F.coalesce(F.col("verdict") == "allow", F.lit(False)).alias("allowed")).withColumns({
        "accepted": ~F.col("held") & F.col("allowed"), "rejected": ~F.col("held") & F.coalesce(F.col("verdict") == "block", F.lit(False)),
        "used": F.col("held") | F.col("verdict").isNull()}), "urls")
    weights = stored(train(urls, order, min_seen), "weights")
    to_score = urls.where("used")
    scored = stored(score(to_score, weights, order).join(to_score.select("url", "n", "verdict", "allowed"), "url"), "scores")
    limit = calibrate(scored.where("verdict is not null").select("score", F.col("allowed").alias("accepted")))

    open_rows = parsed.where("verdict is null").drop("verdict")
    answered = _with_frequent(open_rows, scored.where("verdict is null").select("url", "n", "score"), "url", "n", share)
    names = ["page_id", "host", "path", "rule", "verdict", "score", "lowest"]
    decided = answered.withColumns({"verdict": F.when(F.col("score") < limit, "block").otherwise("allow"), "lowest": F.lit(limit).cast("long")})
    none = F.lit(None).cast("long")
    return parsed.where("verdict is not null").withColumns({"score": none, "lowest": none}).select(names).unionByName(decided.select(names))
