"""Secrets in text, and credentials whose parts only count together.

Matches are found with regular expressions in the JVM: `split` gives the text
between matches and `regexp_extract_all` the matches, so running sums of their
lengths are the positions, in code points. Strong kinds (`assign`, `access`, `hex`) are
reported wherever they stand. Weak kinds are parts that prove nothing alone: an
`identifier` (client id, account id), a `secret` (a long mixed token without a
keyword) and an `endpoint`. An interval join within the document reports an
identifier near a secret, a secret near an identifier, and an endpoint near both,
where near means that the starts lie at most `scope` code points apart.

Defined results: a null text is an empty one and has no spans; equal starts are
ordered by kind as listed; rows are told apart by a number of their own, so
repeated ids and rows without one are fine; an empty table gives an empty one;
columns other than `doc_id` and `text` are not read, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playtrail.llm.store import written

# The patterns of the strong kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

IDENTIFIER = (
    r"""(?i:(?:access|account|client|project|service|tenant|user)[_-]?(?:key[_-]?)?id)"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}"""
)
TOKEN = r"[A-Za-z0-9+/_-]"
SECRET = (
    rf"(?<!{TOKEN})(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z]){TOKEN}{{20,}}"
)
ENDPOINT = r"""(?i:https?|amqps?|jdbc:[a-z]+|mongodb|mysql|postgres|redis|s3)://[^\s"'<>]+"""
KINDS = {
    "assign": ASSIGN,
    "access": ACCESS,
    "hex": HEX,
    "identifier": IDENTIFIER,
    "secret": SECRET,
    "endpoint": ENDPOINT,
}
STRONG = ("assign", "access", "hex")
IDENTIFYING = ("access", "identifier")
SECRET_LIKE = ("assign", "hex", "secret")
SCOPE = 400


def _matches(kind: str) -> list[dict[str, Column]]:
    """Columns, step by step, up to `<kind>`: an array of (kind number, place, gap, size, holds).

    A match is told by its length and that of the text before it, back to the match
    before. Most texts hold nothing of a kind and cost one search for it. No lambda
    refers to a whole array, so the work is linear in the text.
    """
    number = list(KINDS).index(kind)
    pattern = KINDS[kind].replace("\\", "\\\\").replace("'", "\\'")
    empty = "CAST(array() AS ARRAY<STRING>)"
    match, gap = f"x.{kind}_found", f"x.{kind}_gaps"
    holds = f"length(regexp_extract({match}, '{pattern}', 1)) >= {ASSIGN_LENGTH}" if kind == "assign" else "true"
    return [
        {f"{kind}_any": F.expr(f"text RLIKE '{pattern}'")},
        {
            f"{kind}_found": F.expr(f"IF({kind}_any, regexp_extract_all(text, '{pattern}', 0), {empty})"),
            f"{kind}_gaps": F.expr(f"IF({kind}_any, split(text, '{pattern}', -1), {empty})"),
        },
        {
            # The text after the last match comes without a match, and its size is null.
            kind: F.expr(
                f"transform(arrays_zip({kind}_found, {kind}_gaps), (x, i) -> named_struct('kind', {number},"
                f" 'i', i, 'gap', length({gap}), 'size', length({match}), 'holds', {holds}))"
            )
        },
    ]


def located(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row) of all documents, and (row, kind, start, end, inside) of all spans; both written.

    Starts are running sums over a document's matches of a kind. A weak secret is
    `inside` if a strong span holds it: of the strong spans that start no later, the
    one that ends last does if any does. Identifiers and endpoints may hold or
    overlap a strong span. One shuffle serves both windows.
    """
    frame = docs.select(
        F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    for columns in zip(*[_matches(kind) for kind in KINDS]):
        frame = frame.withColumns({k: v for some in columns for k, v in some.items()})
    found = written(
        frame.select(
            "doc_id", F.monotonically_increasing_id().alias("row"), F.concat(*KINDS).alias("matches")
        ),
        "secret-matches",
    )
    names = list(KINDS)
    so_far = F.sum(F.expr("CAST(gap + size AS BIGINT)")).over(Window.partitionBy("row", "kind").orderBy("i"))
    strong = F.col("kind").isin([names.index(k) for k in STRONG])
    reach = F.max(F.when(strong, F.col("end"))).over(Window.partitionBy("row").orderBy("start"))
    inside = (F.col("kind") == names.index("secret")) & (F.col("end") <= reach)
    spans = (
        found.select("row", F.inline("matches"))
        .where("size IS NOT NULL")
        .repartition("row")
        .withColumn("end", so_far)
        .where("holds")
        .select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
        .withColumn("inside", F.coalesce(inside, F.lit(False)))
    )
    return found.select("doc_id", "row"), written(spans, "secret-spans")


def linked_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts of (row, kind, start, end) that stand near their complements."""
    names = list(KINDS)

    def numbers(kinds: tuple[str, ...]) -> list[int]:
        return [names.index(k) for k in kinds]

    slot = F.col("start").cast("long") / scope
    parts = parts.withColumn("slot", F.floor(slot))
    weak = parts.where(~F.col("kind").isin(numbers(STRONG)))

    def near(candidates: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
        around = (
            parts.where(F.col("kind").isin(numbers(kinds)))
            .withColumn("slot", F.explode(F.array(F.col("slot") - 1, F.col("slot"), F.col("slot") + 1)))
            .select("row", "slot", F.col("start").alias("other"), F.col("end").alias("other_end"))
        )
        both = candidates.alias("c").join(
            around.alias("o"),
            F.expr(
                f"c.row = o.row AND c.slot = o.slot AND abs(c.start - o.other) <= {scope}"
                # The value of an identifier is no secret beside it.
                f" AND NOT (c.kind = {names.index('identifier')} AND o.other >= c.start AND o.other_end <= c.end)"
            ),
            "left_semi",
        )
        return both

    identifier, secret, endpoint = (
        weak.where(F.col("kind") == names.index(k)) for k in ("identifier", "secret", "endpoint")
    )
    found = [
        near(identifier, SECRET_LIKE),
        near(secret, IDENTIFYING),
        near(near(endpoint, SECRET_LIKE), IDENTIFYING),
    ]
    return reduce(DataFrame.unionByName, found).drop("slot")


def _text(spans: str) -> Column:
    """kind:start:end of each, by start and then kind, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(
        f"array_join(transform(array_sort({spans}), s -> concat(element_at(array({names}), s.kind + 1),"
        " ':', s.start, ':', s.end)), ',')"
    )


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: counts of the strong kinds, their digest, and all spans."""
    table, spans = located(docs)
    names = list(KINDS)
    numbers = [names.index(k) for k in STRONG]
    parts = spans.where("NOT inside").drop("inside")
    reported = (
        parts.where(F.col("kind").isin(numbers))
        .unionByName(linked_parts(parts, scope))
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("found"))
    )
    none = F.expr("CAST(array() AS ARRAY<STRUCT<start: BIGINT, kind: INT, end: BIGINT>>)")
    joined = table.join(reported, "row", "left").withColumn("all", F.coalesce("found", none))
    base = f"filter(all, s -> s.kind IN ({', '.join(map(str, numbers))}))"
    return joined.select(
        F.col("doc_id"),
        *[
            F.expr(f"CAST(size(filter(all, s -> s.kind = {names.index(k)})) AS BIGINT)").alias(f"n_{k}")
            for k in STRONG
        ],
        F.sha2(_text(base), 256).alias("base_sha256"),
        _text("all").alias("spans"),
    )
