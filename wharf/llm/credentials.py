"""Operator 8: secret scans with multipart credential linking, DataFrame functions only.

Strong matches (assignments of secrets, access keys, long hex strings) are
reported as they are. Weak candidates (account names, mixed tokens) are only
reported where complementary parts of a credential (identifier, secret,
endpoint) stand within the same scope of `scope` characters. The parts of a text
are joined with their neighbours by an interval join in order of position, so
its work is linear in the parts and no pairs are built.

Positions are code points, ends exclusive. Splitting a text at a pattern gives
the lengths between the matches, and their running sum the positions.

Defined cases: a null text is an empty one (no spans); repeated rows give
repeated result rows; matches are found in whole texts of any length; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: The strong patterns. A run of hex digits is always matched as a whole, so its
#: least length may stand in the pattern.
STRONG = {
    "assign": r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"(AKIA[A-Z0-9]+)",
    "hex": r"([0-9a-f]{32,})",
}
LEAST = {"assign": 8, "access": 16, "hex": 32}
WEAK = {
    "account": r"""(?:(?i:user(?:name)?|login|client_?id|account_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""",
    "mixed": r"((?<![A-Za-z0-9+/])(?=[A-Za-z+/]*+[0-9])[A-Za-z0-9+/]{16,})",
    "endpoint": r"((?:(?i:https?)://|(?:(?i:host|endpoint|server))\x20*[:=]\x20*)[A-Za-z0-9.-]+)",
}
KINDS = [*STRONG, *WEAK]
#: What a part is of a credential.
ROLE = {"assign": "secret", "hex": "secret", "mixed": "secret", "access": "identifier", "account": "identifier",
        "endpoint": "endpoint"}


def _matches(kind: str, pattern: str) -> Column:
    """Array of (kind, length before, length, length of group 1) of a kind's matches; empty where none."""
    before = F.transform(F.split("text", pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.length)
    group = F.regexp_extract_all("text", F.lit(pattern), F.lit(1))
    zipped = F.transform(F.arrays_zip(whole.alias("w"), group.alias("g")), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.element_at(before, i + 1).alias("gap"), x["w"].alias("n"),
        F.length(x["g"]).alias("n1"),
        # Mixed tokens need upper and lower case; the digit is in the pattern.
        (x["g"].rlike("[a-z]") & x["g"].rlike("[A-Z]")).alias("two_cases")))
    return F.when(F.col("text").rlike(pattern), zipped)


def parts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(key, kind, start, stop, strong) of every part in the distinct texts; key: the text's md5."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(text.alias("text")).select(
        F.md5("text").alias("key"), *[_matches(k, p).alias(k) for k, p in {**STRONG, **WEAK}.items()])
    arrays = F.concat(*[F.coalesce(F.col(k), F.array()) for k in KINDS])
    any_kind = F.greatest(*[F.size(F.coalesce(F.col(k), F.array())) for k in KINDS]) > 0
    flat = (found.filter(any_kind).select("key", F.explode(arrays).alias("p")).select("key", "p.*")
            .distinct().repartition("key"))
    so_far = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.col("n")).over(so_far)
    strong = F.coalesce(*[F.when((F.col("kind") == k) & (F.col("n1") >= n), True) for k, n in LEAST.items()], F.lit(False))
    weak = F.col("kind").isin("account", "endpoint") | ((F.col("kind") == "mixed") & F.col("two_cases"))
    return (flat.withColumns({"stop": stop, "strong": strong}).filter(F.col("strong") | weak)
            .select("key", "kind", (F.col("stop") - F.col("n")).alias("start"), "stop", "strong"))


def linked(found: DataFrame, scope: int = 300) -> DataFrame:
    """The strong parts, and the weak ones whose complements stand within `scope` characters.

    A weak secret needs an access key, or an account and an endpoint; a weak
    account needs a secret and an endpoint. Weak parts that overlap a strong one
    are part of it."""
    order = Window.partitionBy("key").orderBy("start", "stop", "kind")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)

    def near(which: Column) -> Column:
        gap = F.least(F.col("start") - F.max(F.when(which, F.col("stop"))).over(before),
                      F.min(F.when(which, F.col("start"))).over(after) - F.col("stop"))
        return F.coalesce(gap <= scope, F.lit(False))

    role = lambda r: F.col("kind").isin([k for k, v in ROLE.items() if v == r])
    marks = {"near_key": near(F.col("strong") & role("identifier")), "near_account": near(F.col("kind") == "account"),
             "near_secret": near(role("secret")), "near_endpoint": near(F.col("kind") == "endpoint"),
             "covered": F.coalesce(F.max(F.when(F.col("strong"), F.col("stop"))).over(before) > F.col("start"), F.lit(False))
             | F.coalesce(F.min(F.when(F.col("strong"), F.col("start"))).over(after) < F.col("stop"), F.lit(False))}
    secret = (F.col("kind") == "mixed") & (F.col("near_key") | (F.col("near_account") & F.col("near_endpoint")))
    account = (F.col("kind") == "account") & F.col("near_secret") & F.col("near_endpoint")
    return (found.withColumns(marks).filter(F.col("strong") | (~F.col("covered") & (secret | account)))
            .select("key", "kind", "start", "stop", "strong"))


def span_lists(docs: DataFrame, text_col: str = "text", scope: int = 300) -> DataFrame:
    """(key, n_* of the strong kinds, span_list) of every distinct text with spans."""
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    item = F.struct("start", rank.alias("rank"), "stop", "kind", "strong")
    return (linked(parts(docs, text_col), scope).groupBy("key")
            .agg(*[F.count_if(F.col("strong") & (F.col("kind") == k)).alias(f"n_{k}") for k in STRONG],
                 F.array_sort(F.collect_list(item)).alias("span_list")))


def text_key(text_col: str = "text") -> Column:
    return F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 300) -> DataFrame:
    """Per row: id, the counts of the strong kinds, base_sha256, spans (text) and span_list."""
    text = lambda items: F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
    # Written, so that a much copied text's rows meet it in a join that adaptive execution may split.
    path = scratch_path(docs.sparkSession, "credential-spans")
    span_lists(docs, text_col, scope).write.parquet(path)
    spans = (docs.sparkSession.read.parquet(path)
             .withColumn("base", text(F.filter("span_list", lambda x: x["strong"])))
             .withColumn("spans", text(F.col("span_list"))))
    rows = docs.select(F.col(id_col).alias(id_col), text_key(text_col).alias("key"))
    return rows.join(spans, "key", "left").select(
        id_col, *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in STRONG],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
        "span_list")


def masked(text: Column, span_list: Column, mark: str = "[SECRET]") -> Column:
    """The text with every run of (sorted, perhaps overlapping) spans replaced by a mark; null spans: as it is."""
    def step(done: Column, span: Column) -> Column:
        return F.when(span["stop"] <= done["at"], done).otherwise(F.struct(
            F.concat(done["out"], F.when(span["start"] >= done["at"], F.concat(
                F.substring(text, done["at"].cast("int") + 1, (span["start"] - done["at"]).cast("int")), F.lit(mark)))
                .otherwise("")).alias("out"), span["stop"].cast("long").alias("at")))

    empty = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    done = F.aggregate(span_list, empty, step)
    rest = F.substring(text, done["at"].cast("int") + 1, F.length(text))
    return F.when(span_list.isNull() | text.isNull(), text).otherwise(F.concat(done["out"], rest))
