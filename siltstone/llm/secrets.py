"""Secrets in texts, judged by how widely each value is copied across owners.

Patterns find assignments, access ids and hexadecimal keys; these base spans are
always reported. Long mixed tokens that no pattern covers are further
candidates. Every value is hashed and counted over the whole corpus by distinct
repository and owner. A value that several owners have, or that one owner has in
many repositories, is a copied example; a candidate that looks random and is in
few places of few owners is reported as ``owned``.

Defined results: null or empty text has no spans; rows with equal ids are
separate rows, counted once per owner and repository; a null owner or
repository counts as one; an empty table gives an empty result; a very long text
is scanned by one task, as any other; other columns do not matter and may have
any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.keys import boxed, join_facts, text_of, unboxed
from siltstone.session import settle, written

# The base patterns, in the order in which kinds are listed, and the shortest accepted value.
PASSWORD_WORDS = (
    "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
)
BASE = {
    "assign": (rf"""({PASSWORD_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
}
# Long tokens that could be credentials of another kind.
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
OWNED = "owned"
KINDS = [*BASE, OWNED]

# Owners, and repositories per owner, from which a value counts as a copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 20
# Different characters that a live-looking value has at least.
LIVE_VARIETY = 10


def _long_enough(pattern: str, group: int, least: int) -> str:
    """A pattern of one greedy class can ask for the length itself: no shorter match starts a longer one."""
    prefix = "AKIA" if pattern.startswith("AKIA") else ""
    return pattern if group else f"{pattern[:-1]}{{{least - len(prefix)},}}"


def _hits(kind: int, text: str, pattern: str, group: int, least: int) -> Column:
    """Matches of a pattern in order: the characters before each since the last one, its length and its value."""
    matches, values = F.col(f"_match{kind}"), F.col(f"_value{kind}")
    gaps = F.split(F.col(text), pattern, -1)
    return F.when(F.size(matches) > 0, F.transform(
        F.arrays_zip(matches.alias("m"), values.alias("v"), F.slice(gaps, 1, F.size(matches)).alias("g")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"),
            x["v"].alias("value"), (F.length(x["v"]) >= least).alias("ok"),
        ),
    )).otherwise(F.array().cast("array<struct<kind:int,pos:int,gap:int,len:int,value:string,ok:boolean>>"))


def scan(docs: DataFrame, owner: str, repository: str, *more: str) -> DataFrame:
    """(row, doc_id, owner, repository, hits, *more); every text is read by each pattern once."""
    patterns = [(_long_enough(*p), *p[1:]) for p in BASE.values()] + [(TOKEN, 0, 20)]
    matched = docs.select(
        "doc_id", *more, F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"), text_of().alias("_text"),
        *[F.regexp_extract_all(text_of(), F.lit(p), F.lit(0)).alias(f"_match{k}") for k, (p, _, _) in enumerate(patterns)],
    )
    valued = matched.select("*", *[
        (F.when(F.size(f"_match{k}") > 0, F.regexp_extract_all("_text", F.lit(p), F.lit(g))).otherwise(F.array().cast("array<string>"))
         if g else F.col(f"_match{k}")).alias(f"_value{k}")
        for k, (p, g, _) in enumerate(patterns)
    ])
    return valued.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", *more,
        F.flatten(F.array(*[_hits(k, "_text", *p) for k, p in enumerate(patterns)])).alias("hits"),
    )


def _mixed(value: Column) -> Column:
    """Looks random: letters of either case and digits, or many different characters with digits."""
    variety = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (variety >= LIVE_VARIETY)


def candidates(found: DataFrame) -> DataFrame:
    """(row, owner, repository, kind, start, end, value): base spans, and tokens that overlap none of them."""
    hits = found.select("row", "owner", "repository", F.explode("hits").alias("h")).select("row", "owner", "repository", "h.*")
    so_far = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    spans = hits.withColumn("end", F.sum((F.col("gap") + F.col("len")).cast("long")).over(so_far)).where("ok").select(
        "row", "owner", "repository", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "value",
    )
    text_order = Window.partitionBy("row").orderBy("start", "kind")
    base = F.col("kind") < len(BASE)
    last_end = F.max(F.when(base, F.col("end"))).over(text_order.rowsBetween(Window.unboundedPreceding, -1))
    next_start = F.min(F.when(base, F.col("start"))).over(text_order.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(last_end, F.lit(0)) <= F.col("start")) & (F.coalesce(next_start, F.col("end")) >= F.col("end"))
    return (
        spans.withColumn("_free", free)
        .where(base | (F.col("_free") & _mixed(F.col("value"))))
        .drop("_free")
        .withColumn("secret", F.sha2("value", 256))
    )


def ownership(spans: DataFrame) -> DataFrame:
    """Per secret: its spans, distinct owners and distinct repositories, counted over the whole corpus.

    Three steps, each reduced before its shuffle, so that a secret in a third of
    all documents does not meet in one task.
    """
    by_repository = spans.groupBy("secret", "owner", "repository").agg(F.count(F.lit(1)).alias("spans"))
    by_owner = by_repository.groupBy("secret", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("spans").alias("spans"))
    return by_owner.groupBy("secret").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.sum("spans").alias("spans"),
    )


def judged_spans(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, owners, repositories, example): base spans and the owned tokens."""
    spans = settle(candidates(found))
    judged = join_facts(spans, ownership(spans).withColumn("_weight", F.col("spans")), ["secret"], "_weight", spans.count())
    example = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES * F.col("owners"))
    return judged.where((F.col("kind") < len(BASE)) | ~example).select(
        "row", "kind", "start", "end", "value", "owners", "repositories", example.alias("example"),
    )


def _listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def spans_by_row(found: DataFrame) -> DataFrame:
    """(row, doc_id, all): the sorted spans of every row, an empty list where there are none."""
    per_row = judged_spans(found).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "owners", "repositories", "example"))).alias("all"))
    none = F.array().cast(per_row.schema["all"].dataType)
    return found.select("row", "doc_id").join(per_row, "row", "left").withColumn("all", F.coalesce("all", none))


def _count(kind: int) -> Column:
    return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")


def secret_report(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_example, and the most owners and repositories of a reported value."""
    rows = spans_by_row(settle(scan(docs, owner, repository)))
    base = F.filter("all", lambda s: s["kind"] < len(BASE))
    return rows.select(
        "doc_id",
        *[_count(k).alias(f"n_{name}") for k, name in enumerate(BASE)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"),
        _count(len(BASE)).alias(f"n_{OWNED}"),
        F.size(F.filter("all", lambda s: s["example"])).cast("long").alias("n_example"),
        *[F.coalesce(F.array_max(F.col("all").getField(c)), F.lit(0)).cast("long").alias(f"most_{c}") for c in ("owners", "repositories")],
    )


MASK = "[secret]"


def _islands(spans: DataFrame) -> DataFrame:
    """(row, parts): spans of a row in order, overlapping ones as one."""
    ordered = Window.partitionBy("row").orderBy("start", "kind")
    reach = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int")
    return (
        spans.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(ordered))
        .groupBy("row", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("parts"))
    )


def mask_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """``docs`` with every reported span replaced by MASK and n_chars to match; all rows stay.

    Rows are scanned once and written with what was found; those without a
    match go straight on, the others meet their spans by a number of their own.
    """
    beside = boxed(docs, doc_id=F.col("doc_id"), text=F.col("text"), owner=F.col(owner), repository=F.col(repository))
    found = written(scan(beside, "owner", "repository", "_row"), "scanned")
    parts = _islands(judged_spans(found.drop("_row")))
    text = F.col("_row").getField("text")

    def piece(i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.element_at("parts", F.greatest(i, F.lit(1)))["end"])
        end = F.when(i == F.size("parts"), F.length(text)).otherwise(
            F.element_at("parts", F.least(i + 1, F.size("parts")))["start"])
        return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))

    cut = F.array_join(F.transform(F.sequence(F.lit(0), F.size("parts")), piece), MASK)
    masked = found.where(F.size("hits") > 0).select("row", "_row").join(parts, "row").withColumn("_masked", cut)
    same = found.where(F.size("hits") > 0).select("row", "_row").join(parts.select("row"), "row", "left_anti")
    changed = {"text": F.col("_masked"), "n_chars": F.length("_masked")}
    return (
        unboxed(found.where(F.size("hits") == 0), docs.columns)
        .unionByName(unboxed(same, docs.columns))
        .unionByName(unboxed(masked, docs.columns, **{k: v for k, v in changed.items() if k in docs.columns}))
    )
