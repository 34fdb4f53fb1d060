"""Secret scans: plain patterns, and credentials in several parts linked by an interval join within scopes."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acervo.llm.arrow import slices
from acervo.session import materialise

#: Parts of one credential lie in one scope (lines without a blank line between them), no further apart than so many code points.
REACH = 400
#: Bits a character that a run without a name must carry to be a possible secret.
ENTROPY = 3.5
#: Kinds in the order of the output; the first three are reported wherever they stand, the others only if linked.
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")

VALUE = rb"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = re.compile(rb"(?i:(password|passwd|secret|token|api_?key))" + VALUE + rb"([A-Za-z0-9+/_.=-]+)")
#: Words of which an assignment holds one, in lower case.
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{32,}")
NAMED_ID = re.compile(rb"(?i:\b(?:access_?key_?id|client_?id|key_?id|account(?:_?id)?|user(?:_?name)?|login)\b)" + VALUE + rb"([A-Za-z0-9@._+-]{3,})")
NAMED_KEY = re.compile(rb"(?i:\b(?:secret_?access_?key|private_?key|access_?key|pass(?:phrase|code)?|pwd|credentials?)\b)" + VALUE + rb"([^\s\"',;]{4,})")
ENDPOINT = re.compile(rb"\b[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s\"'<>]+|(?i:\b(?:host(?:_?name)?|endpoint|server|base_?url)\b)" + VALUE + rb"[A-Za-z0-9.-]+(?::[0-9]+)?")
SHORT_ID = re.compile(rb"\bA(?:SIA|IDA|ROA)[A-Z0-9]{12,}")
RUN = re.compile(rb"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,128}(?![A-Za-z0-9+/_=-])")
BLANK = re.compile(rb"\n[ \t\r]*\n")

SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
PART = pa.struct([("role", pa.string()), ("named", pa.bool_()), ("kind", pa.int32()), ("scope", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
SCANNED = (
    "doc_id long, counts array<long>, base array<struct<start: long, kind: int, end: long>>, digest binary, "
    "parts array<struct<role: string, named: boolean, kind: int, scope: long, start: long, end: long>>"
)


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in bytes of the plain patterns: leftmost matches of each that do not overlap, short ones dropped."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def mixed(run: bytes) -> bool:
    """Upper and lower case, a digit, and a spread of characters that words do not have."""
    if run.islower() or run.isupper() or not any(48 <= b <= 57 for b in run):
        return False
    return -sum(n / len(run) * math.log2(n / len(run)) for n in Counter(run).values()) >= ENTROPY


def weak_parts(text: bytes, base: list[tuple[int, int, int]]) -> list[tuple[str, bool, int, int, int]]:
    """``(role, named, kind, start, end)`` in bytes: what may be a part of a credential, and the plain spans by their roles.

    Nothing, unless two roles are there of which one can be reported.
    """
    parts = [("endpoint", True, 5, m.start(), m.end()) for m in ENDPOINT.finditer(text)] if b"://" in text or b":" in text or b"=" in text else []
    if b":" in text or b"=" in text:
        parts += [("id", True, 3, m.start(), m.end()) for m in NAMED_ID.finditer(text)]
        parts += [("secret", True, 4, m.start(), m.end()) for m in NAMED_KEY.finditer(text)]
    parts += [("id", False, 3, m.start(), m.end()) for m in SHORT_ID.finditer(text)]
    parts += [("secret", False, 4, m.start(), m.end()) for m in RUN.finditer(text) if mixed(m[0])]
    # a possible secret inside a plain span is reported already
    starts, ends = [s for s, _, _ in base], np.maximum.accumulate([e for _, _, e in base]) if base else []
    kept = []
    for part in parts:
        before = int(np.searchsorted(starts, part[4]))
        if part[2] != 4 or before == 0 or ends[before - 1] <= part[3]:
            kept.append(part)
    if not kept or len({p[0] for p in kept} | {"id" if k == 1 else "secret" for _, k, _ in base}) < 2:
        return []
    return kept + [("id" if kind == 1 else "secret", True, kind, start, end) for start, kind, end in base]


def scan(docs: DataFrame) -> DataFrame:
    """``SCANNED``: plain spans and their counts for every row, parts and a digest of the text where something might link; in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, spans, digests, parts = [], [], [], []
            for value in batch.column(1).cast(pa.binary()):
                text = value.as_py() or b""
                base = base_spans(text)
                weak = weak_parts(text, base)
                if base or weak:
                    # code points before each byte
                    data = np.frombuffer(text, np.uint8)
                    point = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                counts.append([sum(1 for _, k, _ in base if k == kind) for kind in range(3)])
                spans.append([{"start": int(point[s]), "kind": k, "end": int(point[e])} for s, k, e in base])
                breaks = [m.start() for m in BLANK.finditer(text)] if weak else []
                digests.append(xxhash.xxh128_digest(text) if weak else None)
                parts.append(
                    [
                        {"role": r, "named": n, "kind": k, "scope": int(np.searchsorted(breaks, s)), "start": int(point[s]), "end": int(point[e])}
                        for r, n, k, s, e in weak
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.list_(pa.int64())), pa.array(spans, pa.list_(SPAN)), pa.array(digests, pa.binary()), pa.array(parts, pa.list_(PART))],
                ["doc_id", "counts", "base", "digest", "parts"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCANNED)


def linked_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Rows of ``parts`` (text, scope, role, named, kind, start, end) that a complementary part lies near to, in the same scope.

    An interval join in linear time: for each part the nearest part of each role on either side, by running extremes over
    the starts, instead of all pairs. A secret needs an identifier, one that has a name may have an endpoint instead; an identifier
    needs a secret; an endpoint needs both.
    """
    ahead = W.partitionBy("text", "scope").orderBy("start", "end", "kind").rowsBetween(W.unboundedPreceding, -1)
    behind = W.partitionBy("text", "scope").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(W.unboundedPreceding, -1)
    near = {}
    for role in ("id", "secret", "endpoint"):
        here = F.col("role") == role
        parts = parts.withColumn(f"{role}_before", F.max(F.when(here, F.col("end"))).over(ahead))
        parts = parts.withColumn(f"{role}_after", F.min(F.when(here, F.col("start"))).over(behind))
        gap = F.least(F.col("start") - F.col(f"{role}_before"), F.col(f"{role}_after") - F.col("end"))
        near[role] = F.coalesce(gap <= reach, F.lit(False))
    wanted = (
        F.when(F.col("role") == "secret", near["id"] | (F.col("named") & near["endpoint"]))
        .when(F.col("role") == "id", near["secret"])
        .otherwise(near["id"] & near["secret"])
    )
    return parts.where(wanted & (F.col("kind") > 2)).select("text", "start", "kind", "end")


def written(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row.

    Plain kinds (assignments, access identifiers, long hexadecimal runs) are reported wherever they stand. Weak candidates, such as a
    login name, an unnamed run of mixed characters or an address, are added only where complementary parts stand near each other
    in one scope (see ``linked_parts``). Spans are in code points, end exclusive, by start, then kind.
    A null or empty text has none. The result of a row depends on its text alone, so links are found once for equal texts. Other
    columns are ignored.
    """
    scanned = materialise(scan(docs), "secret-scan")
    some = scanned.where("digest is not null")
    parts = some.select("digest", "parts").dropDuplicates(["digest"]).select(F.col("digest").alias("text"), F.explode("parts").alias("p"))
    found = linked_parts(parts.select("text", "p.*"), reach)
    # as many as the text has parts
    added = found.groupBy("text").agg(F.collect_set(F.struct("start", "kind", "end")).alias("added"))
    plain = scanned.where("digest is null").select("doc_id", "counts", "base", F.lit(None).cast("array<struct<start: long, kind: int, end: long>>").alias("added"))
    both = plain.unionByName(some.join(added, F.col("digest") == F.col("text"), "left").select("doc_id", "counts", "base", "added"))
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return both.select(
        "doc_id",
        *[F.get("counts", F.lit(i)).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:3])],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(spans).alias("spans"),
    )
