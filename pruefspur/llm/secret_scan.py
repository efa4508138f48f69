"""Secret scans with multipart credential linking.

Some findings stand for themselves.  Others (a user name, a random-looking string, an address of a
service) say little alone; they are reported when complementary parts stand near each other in one
scope, found by an as-of join of the parts' intervals in their document.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import sha256_hex

#: The base kinds, in their order, their patterns and least characters.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A longest run of these characters is long enough exactly where it has that many of them.
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20

#: Weak parts of a credential.  An identifier needs a secret, a secret an identifier or an endpoint,
#: an endpoint a secret.
IDENTIFIER = re.compile(
    r"""(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
ENDPOINT = re.compile(r"(?:https?|ftp|ssh|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\s\"'<>]+")
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Bits per character and classes of characters from which a long string looks random.
RANDOM_BITS, RANDOM_CLASSES = 3.5, 3
#: Characters between two parts that may still belong together, within one scope (lines between blank
#: ones).
NEAR = 200
SCOPE = re.compile(r"\n[\x20\t\r]*\n")

PART = "struct<kind: string, start: bigint, stop: bigint, part: string, scope: bigint>"


def _random(text: str) -> bool:
    classes = sum(
        any(f(c) for c in text) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())
    )
    if classes < RANDOM_CLASSES:
        return False
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values()) >= RANDOM_BITS


def parts_of(text: str) -> list[tuple[str, int, int, str]]:
    """Base findings and weak parts of a text: kind, start, stop, role in a credential."""
    found = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= ASSIGN_CHARS:
            found.append(("assign", *m.span(), "secret"))
    for m in ACCESS.finditer(text):
        if len(m[0]) >= ACCESS_CHARS:
            found.append(("access", *m.span(), "identifier"))
    for m in HEX.finditer(text):
        found.append(("hex", *m.span(), "secret"))
    taken = [(a, b) for _, a, b, _ in found]
    weak = []
    for m in ENDPOINT.finditer(text):
        weak.append(("endpoint", *m.span(), "endpoint"))
    for m in IDENTIFIER.finditer(text):
        weak.append(("identifier", *m.span(), "identifier"))
    if weak or any(kind == "access" for kind, *_ in found):
        # A random-looking string is only ever reported beside one of the others.
        weak += [("opaque", *m.span(), "secret") for m in OPAQUE.finditer(text) if _random(m[0])]
    return found + _apart(taken, weak)


def _apart(taken: list[tuple[int, int]], weak: list[tuple[str, int, int, str]]) -> list:
    """The weak parts that touch no base finding."""
    covered = []
    for a, b in sorted(taken):
        if covered and a <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    out, i = [], 0
    for w in sorted(weak, key=lambda x: x[1]):
        while i < len(covered) and covered[i][1] <= w[1]:
            i += 1
        if i == len(covered) or covered[i][0] >= w[2]:
            out.append(w)
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("part", pa.string()), ("scope", pa.int64())]
    )
    for batch in batches:
        lists = []
        for text in batch.column(2):
            value = text.as_py() or ""
            found = parts_of(value)
            cuts = [m.end() for m in SCOPE.finditer(value)] if found else []
            rows = []
            for k, a, b, p in sorted(found, key=lambda x: (x[1], x[2])):
                rows.append({"kind": k, "start": a, "stop": b, "part": p, "scope": bisect_right(cuts, a)})
            lists.append(rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lists, pa.list_(kind))], names=["_row", "_id", "parts"]
        )


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per finding: ``_row`` (a number for the input row), the id, ``kind``, ``start`` and ``stop`` in code points;
    and one row with a null kind for a document without any.

    Base findings are always reported.  A weak part is reported when, in its scope and at most
    ``NEAR`` characters away, stands a part that completes it and shares no character with it.  A null or empty text has no findings;
    repeated rows are scanned each for itself; a null id stays null.  Other columns are not read.
    """
    work = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = dict(work.dtypes)["_id"]
    found = work.mapInArrow(_parts, f"_row bigint, _id {id_type}, parts array<{PART}>")
    rows = found.select("_row", "_id", F.inline_outer("parts"))
    # Each part begins and ends; seen from its begin the parts that ended before, and from its end
    # those that begin after it, lie beside it and not within it.
    ends = F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("begins")), F.struct(F.col("stop").alias("at"), F.lit(0).alias("begins"))))
    rows = rows.repartition("_row").select("*", ends.alias("_end")).select("*", "_end.*")
    by = Window.partitionBy("_row", "scope").orderBy("at", "begins")
    left, right = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    begins = F.col("begins") == 1

    def near(*parts: str):
        is_one = F.col("part").isin(*parts)
        before = F.col("at") - F.max(F.when(is_one & ~begins, F.col("at"))).over(left)
        after = F.min(F.when(is_one & begins, F.col("at"))).over(right) - F.col("at")
        return F.coalesce(F.when(begins, before).otherwise(after) <= NEAR, F.lit(False))

    linked = F.when(F.col("part") == "secret", near("identifier", "endpoint")).otherwise(near("secret"))
    told = (
        rows.withColumn("_linked", linked)
        .groupBy("_row", "_id", "kind", "start", "stop")
        .agg(F.max("_linked").alias("_linked"))
    )
    return told.select(
        "_row",
        F.col("_id").alias(id_col),
        F.when(F.col("kind").isin(*BASE_KINDS) | F.col("_linked"), F.struct("kind", "start", "stop")).alias("span"),
    ).select("_row", id_col, "span.*")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the base counts, a digest of the base spans, and all spans as text."""
    place = F.array_position(F.array(*map(F.lit, BASE_KINDS)), F.col("kind"))
    span = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("stop").cast("string"))
    order = F.struct("start", F.when(place > 0, place).otherwise(len(BASE_KINDS) + 1).alias("k"), "kind", "stop", span.alias("t"))
    base = F.col("kind").isin(*BASE_KINDS)
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.col(c)), lambda x: x["t"]), ",")
    count = lambda k: F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}")
    return (
        findings(docs, id_col, text_col)
        .groupBy("_row", F.col(id_col).alias("_id"))
        .agg(
            *map(count, BASE_KINDS),
            F.collect_list(F.when(base, order)).alias("_base"),
            F.collect_list(F.when(F.col("kind").isNotNull(), order)).alias("_all"),
        )
        .select(
            F.col("_id").alias(id_col),
            *[f"n_{k}" for k in BASE_KINDS],
            sha256_hex(joined("_base")).alias("base_sha256"),
            joined("_all").alias("spans"),
        )
    )
