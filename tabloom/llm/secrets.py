"""Secret scan with corpus-wide ownership frequency.

Candidates are found by patterns, with their places in code points. Their values are then counted over the
whole corpus by distinct repositories (documents) and owners (sources). A value that many owners have is
a widely copied example; one that only few have and that looks random is a live-looking credential.
Candidates of the base kinds are always reported; those of further, weaker kinds are added only if their
value is owner-specific and looks live. A private key's span is its whole block, its value the base64 body alone.

The rows with candidates, a small part, go through the counting; texts are read once and never shuffled.
Values are counted as hashes, with map-side sums, so a value on a third of all rows is one row per task.

Defined cases: a null text counts as empty; a null repository or owner counts as one repository or owner;
repeated rows are counted once as repository and reported twice; an empty table gives an empty result; a
column ``findings`` of the input is replaced.
Helper columns carry the prefix ``_s_``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.sources.shared import materialize

# The base kinds in the order of their spans. The hexadecimal and access patterns state the
# least length themselves; runs of their classes are maximal, so no other match is lost.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}+"
LEAST_ASSIGNED = 6
BASE = ("assign", "access", "hex")

# A private key in PEM form, up to its END line; if that is missing, up to the end of its base64 body.
# Repeated groups are possessive, which Java runs without recursion, so that keys and texts may be of any length.
PEM_NAME = r"[A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
PEM_GAP = r"""(?:[\s"'+,>#*]|\\[nr])"""
PEM_FIELD = r"[A-Za-z][A-Za-z-]*+:\x20[^\r\n\\]*+"
PEM = (
    rf"-----BEGIN {PEM_NAME}(?:"
    rf"(?:[^-]++|-(?!----))*+-----END {PEM_NAME}"
    rf"|(?:{PEM_GAP}*+{PEM_FIELD})*+(?:{PEM_GAP}*+[A-Za-z0-9+/]{{20,}}+={{0,2}})++"
    rf"(?:(?:\r?\n|\\n)[A-Za-z0-9+/]++={{0,2}}(?=[\r\n\\\"']|$))?+)"
)
#: What is not the key itself in a match of PEM: its first and last line, fields, and what is not base64.
PEM_AROUND = rf"-----(?:BEGIN|END) {PEM_NAME}|(?<![A-Za-z0-9+/=-]){PEM_FIELD}|\\[nr]|[^A-Za-z0-9+/=]"
# Publicly documented forms of tokens and keys.
FURTHER = {
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "pem": PEM,
    "bearer": r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}",
    "urlpass": r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]++:[^\s:/@]{6,}+@",
}
#: A part of every match of the pattern, for skipping texts quickly; letters in lower case.
HINTS = {
    "assign": ("passw", "secret", "token", "api"),
    "access": ("akia",),
    "hex": (),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "slack": ("xox",),
    "jwt": ("eyj",),
    "pem": ("private key",),
    "bearer": ("bearer",),
    "urlpass": ("://",),
}
#: A value with this many owners or more is an example that is copied around.
EXAMPLE_OWNERS = 3
#: Least bits of Shannon entropy per character of a live-looking value.
LIVE_BITS = 2.5
SPAN = "kind string, start long, end long, value string"


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """Spans of the leftmost non-overlapping matches. Starts follow from the lengths of what lies between.

    The pattern is searched twice, once for the matches and once for the gaps, in texts that have any.
    """

    def place(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        gaps = F.transform(F.slice(between, 1, F.size(found)), lambda g: F.length(g).cast("long"))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<struct<{SPAN}>>").alias("spans"))

        def add(acc: Column, pair: Column) -> Column:
            begin = acc["at"] + pair["gap"]
            end = begin + F.length(pair["match"])
            span = F.struct(
                F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), pair["match"].alias("value")
            )
            return F.struct(end.alias("at"), F.array_append(acc["spans"], span).alias("spans"))

        pairs = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
        return F.aggregate(pairs, start, add, lambda acc: acc["spans"])

    none = F.array().cast(f"array<struct<{SPAN}>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(F.array(found), lambda m: F.when(F.size(m) > 0, place(m)).otherwise(none))[0]


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the array ``_s_spans`` of all candidates (kind, start, end, value of the secret)."""
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(f"array<struct<{SPAN}>>")

    def search(lower: Column) -> Column:
        parts = []
        for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), *FURTHER.items()):
            spans = _matches(body, pattern, kind)
            if kind == "assign":
                value = lambda x: F.regexp_extract(x["value"], ASSIGN, 2)
                spans = F.filter(
                    F.transform(spans, lambda x: x.withField("value", value(x))),
                    lambda x: F.length(x["value"]) >= LEAST_ASSIGNED,
                )
            if kind == "pem":
                body_of = lambda x: F.regexp_replace(x["value"], PEM_AROUND, "")
                spans = F.filter(
                    F.transform(spans, lambda x: x.withField("value", body_of(x))), lambda x: F.length(x["value"]) > 0
                )
            hint = HINTS[kind]
            if hint:
                seen = F.lit(False)
                for word in hint:
                    seen = seen | F.contains(lower, F.lit(word))
                spans = F.when(seen, spans).otherwise(none)
            parts.append(spans)
        return F.concat(*parts)

    return df.withColumn("_s_spans", F.transform(F.array(F.lower(body)), search)[0])


def entropy(value: Column) -> Column:
    """Shannon entropy of the characters, in bits per character."""
    letters = F.split(value, "")
    n = F.greatest(F.length(value), F.lit(1))

    def bits(c: Column) -> Column:
        share = (F.length(value) - F.length(F.replace(value, c, F.lit("")))) / n
        return -share * F.log(share) / math.log(2)

    kept = F.filter(F.array_distinct(letters), lambda c: c != "")
    return F.aggregate(kept, F.lit(0.0), lambda total, c: total + bits(c))


def ownership(found: DataFrame, repository: str, owner: str) -> DataFrame:
    """Per candidate value (hash): distinct repositories and owners, over all rows."""
    values = found.select(
        F.explode(F.array_distinct(F.transform("_s_spans", lambda x: F.sha2(x["value"], 256)))).alias("_s_value"),
        F.struct(repository).alias("repository"),
        F.struct(owner).alias("owner"),
    ).distinct()
    # Two levels of sums, so that a value in very many repositories is counted by many tasks.
    by_owner = values.groupBy("_s_value", "owner").agg(F.count(F.lit(1)).alias("pairs"))
    return by_owner.groupBy("_s_value").agg(
        F.sum("pairs").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners")
    )


def find(
    df: DataFrame,
    text: str = "text",
    repository: str = "doc_id",
    owner: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
    drop_text: bool = False,
) -> DataFrame:
    """``df`` with ``findings``: array of (kind, start, end, value_sha256, n_repositories, n_owners, class).

    ``class`` is ``example`` for values that ``example_owners`` or more have, ``live`` for owner-specific
    ones that look random, else ``weak``. Findings are ordered by start, then kind as listed.
    """
    scanned = scan(df.drop("findings"), text)
    scanned = scanned.drop(text) if drop_text else scanned
    stored = materialize(scanned.withColumn("_s_row", F.monotonically_increasing_id()))
    hits = stored.where(F.size("_s_spans") > 0)
    owned = ownership(hits, repository, owner)
    rank = {kind: i for i, kind in enumerate((*BASE, *FURTHER))}
    order = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    each = hits.select("_s_row", F.explode("_s_spans").alias("span")).select(
        "_s_row",
        "span.kind", "span.start", "span.end",
        F.sha2("span.value", 256).alias("_s_value"),
        (entropy(F.col("span.value")) >= LIVE_BITS).alias("random"),
    )
    judged = each.join(owned, "_s_value").withColumn(
        "class",
        F.when(F.col("n_owners") >= example_owners, "example").when(F.col("random"), "live").otherwise("weak"),
    )
    reported = judged.where(F.col("kind").isin(*BASE) | (F.col("class") == "live"))
    findings = reported.groupBy("_s_row").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "start", order[F.col("kind")].alias("rank"), "end", "kind",
                    F.col("_s_value").alias("value_sha256"), "n_repositories", "n_owners", "class",
                )
            )
        ).alias("findings")
    )
    # Rows without candidates, by far the most, are not shuffled.
    none = F.array().cast(findings.schema["findings"].dataType)
    found = hits.join(findings, "_s_row", "left").withColumn("findings", F.coalesce("findings", none))
    others = stored.where(F.size("_s_spans") == 0).withColumn("findings", none)
    return found.unionByName(others).drop("_s_row", "_s_spans")


def joined(findings: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(findings, text), ",")


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` (with ``findings``) with every finding but the examples replaced by ``mark``; overlaps once."""
    secret = F.filter("findings", lambda x: x["class"] != "example")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        piece = F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.greatest(x["start"] - acc["at"], F.lit(0)).cast("int"))
        fresh = x["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], piece, F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.length(text)))
    return df.withColumn(text, F.when(F.size(secret) == 0, F.col(text)).otherwise(F.aggregate(secret, start, add, rest)))
