"""Secret scan with corpus-wide ownership of what it finds.

Every candidate's value is hashed and counted by distinct owners and distinct
repositories. A value that many owners have is a copied example; one that few
have looks live. Beside the fixed base kinds, the method adds random-looking
tokens that stand alone (kind ``token``) if few owners have them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weekgrid.llm.common import rows_of, stored, table

KINDS = ["assign", "access", "hex", "token"]
# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# What any of them needs; a linear-time scan that spares the others most texts.
HINT = r"[sS][wW][oO]?[rR]?[dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[kK][eE][yY]|AKIA[A-Z0-9]{12}|[A-Za-z0-9+/_=-]{20}"
ENTROPY, EXAMPLE_OWNERS = 3.5, 3
CANDIDATE = "struct<kind:int,start:long,stop:long,value:string>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of the base kinds, by start, then kind."""
    found = [(0, *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(1, *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(2, *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def looks_random(value: str, least: float = ENTROPY) -> bool:
    """Has lower or upper letters, digits, and at least ``least`` bits a character."""
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= least


def token_spans(text: str, base: list) -> list[tuple[int, int, int, str]]:
    """Random-looking tokens that touch no base span."""
    return [
        (3, *m.span(), m[0])
        for m in TOKEN.finditer(text)
        if looks_random(m[0]) and not any(a < m.end() and m.start() < b for _, a, b, _ in base)
    ]


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b, *_ in spans)


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """Per row its candidates, values as hashes, and the digest of the base ones."""

    def run(batches):
        for (doc_id, repo, owner), texts in rows_of(batches):
            hint = pc.match_substring_regex(pa.array(texts, pa.large_binary()).cast(pa.large_string()), HINT).to_pylist()
            found, digests = [], []
            for text, hit in zip(texts, hint):
                base, more = [], []
                if hit:
                    text = text.decode()
                    base = base_spans(text)
                    more = token_spans(text, base)
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                found.append([
                    {"kind": k, "start": a, "stop": b, "value": hashlib.sha256(v.encode()).hexdigest()}
                    for k, a, b, v in sorted(base + more)
                ])
            kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("value", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [doc_id, repo, owner, pa.array(digests), pa.array(found, kind)], ["doc_id", "repo", "owner", "base_sha256", "found"]
            )

    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(repo_col).cast("string").alias("repo"),
        F.col(owner_col).cast("string").alias("owner"), F.col(text_col).cast("string").alias("text"),
    )
    return source.mapInArrow(run, f"doc_id long, repo string, owner string, base_sha256 string, found array<{CANDIDATE}>")


def ownership(found: DataFrame) -> DataFrame:
    """value, n_owners, n_repos: distinct ones, a null being one of them. Pairs are
    made distinct first, so a value that is everywhere is no hot key."""
    def distinct(column, name):
        pairs = found.select("value", column).distinct()
        return pairs.groupBy("value").agg(F.count(F.lit(1)).alias(name))

    return distinct("owner", "n_owners").join(distinct("repo", "n_repos"), "value")


def scan(
    docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, id_col: str = "doc_id", text_col: str = "text",
    repo_col: str = "doc_id", owner_col: str = "source",
) -> DataFrame:
    """Spans of every whole text with their ownership, one row per input row.

    ``spans`` is an array of (start, kind, stop, n_owners, n_repos, live, value)
    by start, then kind, the value hashed; ``live`` if fewer than ``example_owners`` owners have the value.
    Base spans are all there; ``token`` spans only if live. A null text is empty.
    A null owner or repository is one owner or repository. Repeated rows are rows
    of their own (they add no owner). An empty table gives no rows.
    """
    rows = stored(candidates(docs, id_col, text_col, repo_col, owner_col).withColumn("row", F.monotonically_increasing_id()), "secrets")
    each = rows.select("row", "repo", "owner", F.explode("found").alias("f")).select("row", "repo", "owner", "f.*")
    judged = each.join(ownership(each), "value").withColumn("live", F.col("n_owners") < example_owners)
    kept = judged.where((F.col("kind") < 3) | F.col("live"))
    spans = kept.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "n_owners", "n_repos", "live", "value"))).alias("spans")
    )
    return rows.select("row", "doc_id", "base_sha256").join(spans, "row", "left").select(
        "doc_id", "base_sha256",
        F.coalesce("spans", F.expr("cast(array() as array<struct<start:bigint,kind:int,stop:bigint,n_owners:bigint,n_repos:bigint,live:boolean,value:string>>)")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows with every live span's value, or overlapping values, replaced by
    ``mark``; copied examples stay. Spans are found again in the row's own text,
    so rows that share an id cannot take each other's."""
    found = scan(docs, id_col=id_col, text_col=text_col, **options)
    live = found.select("doc_id", F.explode(F.filter("spans", lambda s: s["live"])).alias("s")).groupBy("doc_id").agg(
        F.collect_set("s.value").alias("values")
    )
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(c) for c in others]).alias("row"), F.col(id_col).cast("long").alias("own"), F.col(text_col).cast("string").alias("text"))
    both = rows.join(live.hint("shuffle_hash"), F.col("own").eqNullSafe(F.col("doc_id")), "left").select("row", "values", "text")

    def run(batches):
        for (row, values), texts in rows_of(batches):
            out = []
            for hashed, text in zip(values.to_pylist(), texts):
                if hashed and text:
                    text, end, parts = text.decode(), 0, []
                    base = base_spans(text)
                    for _, a, b, v in sorted(base + token_spans(text, base), key=lambda s: (s[1], -s[2])):
                        if hashlib.sha256(v.encode()).hexdigest() in hashed:
                            at = max(end, a + text[a:b].rindex(v))
                            if b > end:
                                parts += [text[end:at], mark] if at > end or not parts else []
                                end = b
                    text = ("".join(parts) + text[end:]).encode()
                out.append(text)
            yield pa.RecordBatch.from_arrays([row, pa.array(out, pa.binary()).cast(pa.string())], ["row", "text"])

    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    return both.mapInArrow(run, schema).select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.{c}").alias(c) for c in docs.columns])


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(k) for k in KINDS])
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    # A predicate of two parameters would get the position as its second.
    of_kind = lambda k: lambda s: s["kind"] == k
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[count(of_kind(k)).alias(f"n_{KINDS[k]}") for k in range(3)],
        "base_sha256",
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",").alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_example"),
    )
