"""Every registered query, column by column, against a plain version on the small tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import tokenizers

from weekgrid.llm import language, registry, secret_scan
from weekgrid.llm.common import table

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in table(spark, SMALL, "documents").collect()}


@pytest.fixture(scope="module")
def run(spark):
    def of(name):
        return {r[0]: r for r in registry.queries()[name](spark, SMALL).collect()}

    return of


def test_op1(run, docs):
    got, seen = run("op1_substring_dedup"), set()
    for i in sorted(docs):
        words = WORD.findall(docs[i]["text"] or "")
        gone = [False] * len(words)
        for a in range(len(words) - 19):
            key = tuple(words[a : a + 20])
            if key in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(key)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        assert tuple(got[i][:4]) == (i, len(words), sum(gone), sha(kept))
    assert len(got) == len(docs)


ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.A) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(secret_scan.KINDS[k], a, b) for a, k, b in sorted(found)]


def holds(row, text):
    spans = base(text)
    said = [f"{k}:{a}:{b}" for k, a, b in spans]
    counts = Counter(k for k, *_ in spans)
    assert (row["n_assign"], row["n_access"], row["n_hex"]) == (counts["assign"], counts["access"], counts["hex"])
    assert row["base_sha256"] == sha(",".join(said))
    shown = [s for s in row["spans"].split(",") if s]
    assert [s for s in shown if not s.startswith("token:")] == said
    order = [(int(a), secret_scan.KINDS.index(k)) for k, a, _ in (s.split(":") for s in shown)]
    assert order == sorted(order)


def test_op2(run, docs):
    got = run("op2_secret_scan")
    assert len(got) == len(docs)
    for i, row in docs.items():
        holds(got[i], row["text"] or "")


def test_op2_on_texts_of_every_kind(spark, tmp_path):
    key, run, word = "AKIA" + "B7" * 8, "0a" * 16, "password=longenough1"
    texts = [word, key, run, f"{run} {key} {word}", f"token={run} é {word} {word}", f"{key}{key} {run}{run}f", "token = short", None, "", f"API_KEY: '{run}'", "ſecret=notasciicase secret=isascii0"]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(0, word, None), (0, word, "s"), (None, key, None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, owner string, row int")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.queries()["op2_secret_scan"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        holds(r, (key if r["doc_id"] is None else texts[r["doc_id"]]) or "")
    assert secret_scan.scan(frame.limit(0)).count() == 0


def grams(text):
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        out.update(word)
        edged = f" {word} "
        out.update(edged[i : i + 2] for i in range(len(edged) - 1))
        out.update(edged[i : i + 3] for i in range(len(edged) - 2))
    return out


def ranked(counts, length):
    """Ranks by frequency, ties by code points with a word's edge first."""
    top = sorted(counts, key=lambda g: (-counts[g], [1 if c == " " else ord(c) for c in g] + [0] * (3 - len(g))))[:length]
    return {g: r for r, g in enumerate(top)}


def test_op3(run, docs):
    """Out-of-place distances from dictionaries of n-grams."""
    length = language.PROFILE
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs}
    counts = {}
    for i, row in docs.items():
        if not held[i] and row["text"] is not None and row["lang"] is not None:
            counts.setdefault(row["lang"], Counter()).update(grams(row["text"]))
    profiles = {lang: ranked(c, length) for lang, c in counts.items()}
    got = run("op3_language_id")
    assert len(got) == len(docs)
    for i, row in docs.items():
        mine = ranked(grams(row["text"] or ""), length)
        far = {x: sum(min(abs(p[g] - r), length) if g in p else length for g, r in mine.items()) for x, p in profiles.items()}
        assert got[i]["held_out"] == held[i]
        if not mine:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        best = min(sorted(far), key=far.get)
        assert got[i]["lang_pred"] == best and got[i]["score"] == pytest.approx(1 - far[best] / (len(mine) * length))


def test_op4(spark, docs):
    core = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = registry.queries()["op4_packing"](spark, SMALL).collect()
    mine, at = {}, 0
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["sequence_id"] * 2048 + r["offset"] == at and r["offset"] + r["length"] <= 2048
        at += r["length"]
        mine.setdefault(r["doc_id"], []).append(r)
    assert set(mine) == set(docs)
    for i, pieces in mine.items():
        ids = np.array(core.encode(docs[i]["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        begin = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (begin, len(ids)) and r["ids_crc32"] == zlib.crc32(ids[begin : begin + r["length"]].tobytes())
            begin += r["length"]
        assert begin == len(ids)


def test_op5(run, docs):
    sets, where = {}, {}
    for i, row in docs.items():
        w = WORD.findall((row["text"] or "").translate(LOWER))
        sets[i] = {tuple(w[a : a + 5]) for a in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in {(a, b) for ids in where.values() for a in ids for b in ids if a < b}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = run("op5_jaccard_join")
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (len(sets[i]), find(i)) for i in docs}


def test_op6(run, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = run("op6_token_counts")
    want = {i: (len((r["text"] or "").encode()), n := len(model.encode(r["text"] or "")), n > 4096) for i, r in docs.items()}
    assert {i: tuple(r[1:4]) for i, r in got.items()} == want


def test_op7(run, spark):
    rows = table(spark, SMALL, "embeddings").collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r["label"] for r in rows])
    link = (x @ x.T >= 0.93) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    ids = np.array([r["vec_id"] for r in rows])
    got = run("op7_embedding_dedup")
    assert len(got) == len(rows)
    for i, n in zip(ids, link.sum(1)):
        r = got[i]
        assert r["n_links"] <= n and r["kept"] == (r["component_id"] == i) and r["component_id"] <= i
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * link.sum()


def test_op9(run, docs):
    got, order = run("op9_winnowing"), sorted(docs, reverse=True)
    prints = {i: {p.split(":")[1] for p in got[i]["fingerprint"].split(",") if p} for i in docs}
    same = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i, after in zip(order, order[1:] + order[:1]):
        text, other = docs[i]["text"] or "", docs[after]["text"] or ""
        half = len(text) // 2
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == sha(text[: len(text) - half] + other[:half])
        edited = {p.split(":")[1] for p in got[i]["edited_fingerprint"].split(",") if p}
        assert got[i]["near_next"] == pytest.approx(same(prints[i], prints[after])) and got[i]["near_edited"] == pytest.approx(same(prints[i], edited))
    by_text = {}
    for i in docs:
        assert by_text.setdefault(docs[i]["text"] or "", got[i]["fingerprint"]) == got[i]["fingerprint"]


def test_op10(run, docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    core = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = run("op10_byte_bpe")
    for i, row in docs.items():
        ids = core.encode_ordinary(row["text"] or "")
        assert tuple(got[i][1:4]) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(row["text"] or ""))
    assert len(got) == len(docs)


def test_every_query_is_checked():
    """Those not checked above have SQL, or their own test beside their operator."""
    checked = {f"op{n}" for n in (1, 2, 3, 4, 5, 6, 7, 9, 10, 13)}
    assert {name.split("_")[0] for name in registry.queries()} == checked | {name.split("_")[0] for name in registry.sql()}
