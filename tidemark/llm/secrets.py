"""Secret scan with corpus-wide ownership frequency.

Base patterns give spans in every text. Beside them, long mixed tokens are
candidates. The hash of every candidate value is counted over the whole corpus
by distinct repository and owner: a value that one owner alone uses, in few
repositories, looks live; one that many owners have copied, or that one owner has
spread over many repositories, is an example. Live-looking candidates outside
the base spans are added as spans of kind ``owned``; base spans all stay and are
only told apart.

Positions come from the pieces between the matches: ``split`` and
``regexp_extract_all`` see the same leftmost matches, so running lengths of both
give starts and ends in code points. Values travel as hashes only.

Null text: empty, no span. Null owner or repository: counted as one of its own.
A repeated row gets the spans of its twin and adds no owner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_key
from tidemark.operators.control import materialize

# fixed values: the base patterns, the group that holds the value, its least length
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
#: A value of more owners than this is a copied example.
MAX_OWNERS = 1
#: So is one in more repositories than this, even if one owner has them all.
MAX_REPOSITORIES = 2

#: Matches whose places are summed together.
BLOCK = 256

_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def pattern_spans(text: str, pattern: str, kind: int, group: int = 0) -> Column:
    """Matches of ``pattern`` as (start, kind, end, hash of the value)."""
    lit = F.lit(pattern)
    found = F.regexp_extract_all(text, lit, F.lit(0))
    values = F.regexp_extract_all(text, lit, F.lit(group)) if group else found
    gaps = F.transform(F.split(F.col(text), pattern, -1), F.length)
    rows = F.zip_with(
        F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), F.length(m).alias("len"))),
        values,
        lambda x, v: F.struct(x["gap"].alias("gap"), x["len"].alias("len"), v.alias("value")),
    )
    real = F.filter(rows, lambda r: r["len"].isNotNull())
    # bound to a variable: a lambda that names the expression would run the pattern again for every block
    placed = F.get(F.transform(F.array(F.struct(real.alias("rows"))), lambda s: _placed(s["rows"], kind)), F.lit(0))
    return F.when(F.col(text).rlike(pattern), placed).otherwise(F.array().cast(_SPAN))


def _placed(rows: Column, kind: int) -> Column:
    """Spans of (gap, len, value) rows: starts are running sums of both. Growing
    an array by one copies it, so sums run over blocks first and then inside
    each, which keeps long texts from costing the square of their matches."""
    blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int")))
    block = lambda b: F.slice(rows, b * BLOCK + 1, BLOCK)
    sums = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), lambda at, r: at + r["gap"] + r["len"]))
    grown = lambda kind_: F.struct(F.lit(0).alias("at"), F.array().cast(kind_).alias("out"))
    starts = F.aggregate(
        sums, grown("array<int>"),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"],
    )

    def step(acc, r):
        start = acc["at"] + r["gap"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + r["len"]).alias("end"), r["value"].alias("value"))
        return F.struct((start + r["len"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    inside = F.zip_with(
        blocks, starts,
        lambda b, at: F.aggregate(block(b), F.struct(at.alias("at"), F.array().cast(_SPAN).alias("out")), step, lambda acc: acc["out"]),
    )
    return F.flatten(inside)


def _hashed(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("value")))


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _free(spans: DataFrame) -> DataFrame:
    """``spans`` without the candidates that overlap a base span of their text:
    those before are known by their greatest end, those behind by their least
    start, both as running values, so many spans of one text cost no square."""
    base = F.col("kind") < 3
    running = (Window.unboundedPreceding, Window.currentRow)
    of_text = Window.partitionBy("rk")
    before = F.max(F.when(base, F.col("end"))).over(of_text.orderBy("start", "kind").rowsBetween(*running))
    behind = F.min(F.when(base, F.col("start"))).over(of_text.orderBy(F.col("start").desc(), F.col("kind").desc()).rowsBetween(*running))
    free = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(behind, F.col("end")) >= F.col("end"))
    return spans.withColumn("_free", base | free).where("_free").drop("_free")


def scan(
    docs: DataFrame, repository: Column, owner: Column, id_col: str = "doc_id", text_col: str = "text",
    max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Per row of ``docs``: id, ``base`` and ``spans``, arrays of (start, kind,
    end, value hash, owners, repositories, live) by start and kind, and ``joined``
    texts of both. ``kind`` indexes ``KINDS``."""
    texts = docs.select(
        row_key(id_col, text_col).alias("rk"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
        repository.cast("string").alias("repo"), owner.cast("string").alias("owner"),
    )
    assign = F.filter(pattern_spans("t", ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= 6)
    mixed = F.filter(pattern_spans("t", CANDIDATE, 3), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    found = texts.select(
        "rk", "doc_id", "repo", "owner",
        _hashed(F.concat(assign, pattern_spans("t", ACCESS, 1), pattern_spans("t", HEX, 2))).alias("base"), _hashed(mixed).alias("other"),
    )
    found = materialize(found, "secret-spans")
    spans = _free(found.select("rk", "repo", "owner", F.explode(F.concat("base", "other")).alias("s")).select("rk", "repo", "owner", "s.*").distinct())
    owners = (
        spans.select("value", F.coalesce("owner", F.lit("\0")).alias("owner"), F.coalesce("repo", F.lit("\0")).alias("repo")).distinct()
        .groupBy("value", "owner").agg(F.count("*").alias("repos"))
        .groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repositories"))
    )
    judged = (
        spans.select("rk", "start", "kind", "end", "value").distinct().join(owners, "value")
        .withColumn("live", (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories))
        .where("kind < 3 OR live")
        .groupBy("rk").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "value", "owners", "repositories", "live"))).alias("spans"))
    )
    out = found.select("rk", "doc_id").join(judged, "rk", "left")
    none = F.array().cast(judged.schema["spans"].dataType)
    out = out.withColumn("spans", F.coalesce("spans", none))
    out = out.withColumn("base", F.filter("spans", lambda s: s["kind"] < 3))
    return out.select(F.col("doc_id").alias(id_col), "base", "spans", _joined(F.col("base")).alias("base_joined"), _joined(F.col("spans")).alias("joined"))
