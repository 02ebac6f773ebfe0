"""Each operator against a brute-force version on a small table with odd rows."""

import base64
import hashlib
import types
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import functions as F

from weekgrid.llm import bpe_tree, chat, common, components, embeddings, jaccard, language, packing, pieces, secret_scan, substrings, winnowing

rng = np.random.default_rng(3)
VOCABULARY = ["of", "the", "and"] + ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]


def prose(n):
    return " ".join(rng.choice(VOCABULARY, n))


BASE, PASSAGE = prose(300).split(), prose(60)


def near(i):
    words = list(BASE)
    for k in rng.choice(300, i % 9, replace=False):
        words[k] = f"x{i}y{k}"
    return " ".join(words)


TEXTS = [None, "", "   \n", "one", "two words", "aé ß 中文  x", prose(40)] + [near(i) for i in range(60)]
TEXTS += [prose(30) + " " + PASSAGE + "\n" + prose(25) for _ in range(6)] + ["la " * 200, prose(5000)] + [TEXTS[10]] * 5
ROWS = [(i, t, ["en", "de", None][i % 3], f"src{i % 4}") for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, word string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_substrings(docs, empty):
    seen, want = set(), {}
    for i, t, *_ in ROWS:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for a in range(len(w) - 19):
            key = tuple(w[a : a + 20])
            if key in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(key)
        want[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    got = substrings.without_repeats(docs).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got} == want
    assert all((r["text"] or "").split() == r["kept"].split() for r in got if r["doc_id"] != 5)
    assert substrings.without_repeats(empty).count() == 0


def test_repeated_rows_keep_their_words(docs):
    twice = docs.where("doc_id = 73").unionByName(docs.where("doc_id = 73"))
    assert [r["n_removed"] for r in substrings.without_repeats(twice).collect()][0] >= 0


def test_jaccard(docs, empty):
    low = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    sets = []
    for _, t, *_ in ROWS:
        w = (t or "").encode().translate(low).split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()})
    root = list(range(len(ROWS)))
    for _ in range(len(ROWS)):
        for a in range(len(ROWS)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    root[a] = root[b] = min(root[a], root[b])
    want = {i: (len(s), root[i]) for i, s in enumerate(sets)}
    for leaf, rounds in ((128, 3), (4, 2)):
        got = jaccard.jaccard_join(docs, leaf=leaf, rounds=rounds).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert jaccard.jaccard_join(empty).count() == 0


def test_jaccard_chain_that_drifts_from_its_pivot(spark):
    """A long text, a chain of ever shorter ones that moves away from it, and one
    that links with the chain's end only, in regions whose pivot is the long text."""
    made = [f"w{i}" for i in range(87)]
    value = {w: jaccard.shingle_sets([w.encode()], 1)[1][0] for w in made}
    made.sort(key=value.get)
    common, own, line = made[:7], made[7:12], made[12:]
    sets = [set(common + line[3 * i : 47 + 2 * i]) for i in range(15)]
    sets.append(set(common + own + line[45:75]))
    links = [(a, b) for b in range(16) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert [a for a, b in links if b == 15] == [14] and {b for _, b in links} == set(range(1, 16))
    rows = spark.createDataFrame([(i, " ".join(sorted(s))) for i, s in enumerate(sets)], "doc_id long, text string")
    got = jaccard.jaccard_join(rows, words=1).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict.fromkeys(range(16), 0)


def test_jaccard_holds_little_text_at_once(spark, tmp_path, monkeypatch):
    """Neither the batches that workers get nor the texts they hash at once grow with the rows of a partition."""
    noted = f"{tmp_path}/noted"

    def reading(batches, size=common.CHUNK_BYTES):
        def passed():
            for batch in batches:
                with open(noted, "a") as f:
                    f.write(f"batch {batch.nbytes}\n")
                yield batch

        for columns, texts in common.rows_of(passed(), size):
            with open(noted, "a") as f:
                f.write(f"chunk {sum(map(len, texts))}\n")
            yield columns, texts

    monkeypatch.setattr(jaccard, "rows_of", reading)
    words = F.concat_ws(" ", F.sequence(F.col("id") * 200, F.col("id") * 200 + 199))
    rows = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), words.alias("text"))
    before = spark.conf.get(common.BATCH)
    assert jaccard.jaccard_join(rows).where("component_id = doc_id").count() == 4000
    assert spark.conf.get(common.BATCH) == before
    with open(noted) as f:
        sizes = [(kind, int(n)) for kind, n in map(str.split, f)]
    chunks = [n for kind, n in sizes if kind == "chunk"]
    assert sum(chunks) > 2 * 5_000_000 and max(chunks) <= 250_000
    assert max(n for kind, n in sizes if kind == "batch") < 2_200_000


def test_byte_bpe(docs):
    with open(bpe_tree.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    core = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: np.array(core.encode_ordinary(t or ""), "<u4").tobytes() for i, t, *_ in ROWS}
    for leaf in (16, 2048):
        got = bpe_tree.encode_documents(docs, leaf=leaf).collect()
        assert {r["doc_id"]: bytes(r["ids"]) for r in got} == want
        assert all(bytes(r["decoded"]) == (TEXTS[r["doc_id"]] or "").encode() for r in got)


def test_token_counts(docs, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = {i: len(model.encode(t or "")) for i, t, *_ in ROWS}
    for sample, head in ((1, 50), (32, 200_000)):
        got = pieces.token_counts(docs, head_size=head, sample=sample).collect()
        assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    assert pieces.token_counts(empty).count() == 0


def test_word_encoder():
    core = tokenizers.Tokenizer.from_file(packing.VOCABULARY)
    texts = [(t or "").encode() for t in TEXTS] + ["\x0b a\x0cb  \r\n c\x1cd\x85e\u2003f \xa0".encode(), b" ", "\t".encode()] * 2
    for size in (0, 5, 400_000):
        encoder = packing.WordEncoder(packing.VOCABULARY, size)
        for part in (texts, texts[::-1], texts[5:9], [b""], [None], texts):
            ids, sizes = encoder.encode(pa.array(part, pa.large_binary()))
            mine = np.split(ids, np.cumsum(sizes)[:-1])
            want = [core.encode((t or b"").decode(), add_special_tokens=False).ids for t in part]
            assert [x.tolist() for x in mine] == want and len(encoder.known) <= size


def test_packing_of_long_and_repeated_rows(spark):
    rows = spark.createDataFrame([(None, "many words " * 3000), (3, "x"), (3, "x"), (None, None)], "doc_id long, text string").withColumns({"part": F.lit(1), "ids": F.lit(2)})
    got = packing.pack(rows).collect()
    core = tokenizers.Tokenizer.from_file(packing.VOCABULARY)
    want = {len(core.encode(t or "", add_special_tokens=False).ids) + 1: n for t, n in (("many words " * 3000, 1), ("x", 2), (None, 1))}
    for length, n in want.items():
        mine = [r for r in got if r["doc_tokens"] == length]
        assert sum(r["length"] for r in mine) == n * length
    assert sum(r["length"] for r in got) == sum(k * n for k, n in want.items()) and any(r["start"] > 0 for r in got)


def test_packing(docs, empty):
    core = tokenizers.Tokenizer.from_file(packing.VOCABULARY)
    want = {i: core.encode(t or "", add_special_tokens=False).ids + [1] for i, t, *_ in ROWS}
    rows = packing.pack(docs).collect()
    for i, ids in want.items():
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in mine) == np.array(ids, "<u4").tobytes()
        assert all(r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and r["doc_tokens"] == len(ids) for r in mine)
    at = 0
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["sequence_id"] * 2048 + r["offset"] == at
        at += r["length"]
    assert packing.pack(empty).count() == 0


def test_secrets(spark):
    live, shown = "token = 'Zq81kfP0aa93Lq'", "AKIA" + "B7" * 8
    texts = [f"é {live} end", None, f"{shown} x", f"x {shown}", f"{shown}", "f" * 31 + " " + "0a" * 16, "password=short"]
    rows = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in secret_scan.scan(rows).collect()}
    spans = {i: [(s["kind"], s["start"], s["stop"], s["live"]) for s in r["spans"]] for i, r in got.items()}
    assert spans[0] == [(0, 2, 2 + len(live) - 1, True)] and spans[1] == [] and spans[6] == []
    assert spans[2] == [(1, 0, 20, False)] and spans[5] == [(2, 32, 64, True)]
    assert got[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(rows).collect()}
    assert clean[0] == "é token = '[SECRET]' end" and clean[3] == texts[3] and clean[1] is None


def test_secret_digest_is_by_start(spark):
    key, run, word = "AKIA" + "B7" * 8, "0a" * 16, "password=longenough1"
    rows = spark.createDataFrame([(0, f"{run} {key} {word}", "s"), (1, f"token={run}", "s")], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["base_sha256"] for r in secret_scan.scan(rows).collect()}
    want = {0: "hex:0:32,access:33:53,assign:54:74", 1: "assign:0:38,hex:6:38"}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}


def test_language(spark, docs, empty):
    made = [(i, (f"{w} " * (3 + i % 5)), lang, "s") for i in range(200) for w, lang in [(("the thing", "en"), ("über straße", "de"))[i % 2]]]
    rows = spark.createDataFrame(made + [(900, None, "en", "s"), (901, "12 ..", "en", "s")], docs.schema)
    got = {r["doc_id"]: r for r in language.identify(rows).collect()}
    assert all(got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1 for i, _, lang, _ in made)
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und"
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert language.identify(empty).count() == 0 and language.spoken(rows).count() == 200


def test_embeddings(spark):
    x = rng.standard_normal((40, 16))
    v = np.concatenate([x, x + 0.1 * rng.standard_normal((40, 16)), x[:5]]).astype(np.float32)
    rows = [(i, r.tolist(), i % 40 % 2) for i, r in enumerate(v)] + [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 0), (903, v[0].tolist(), None)]
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    label = np.arange(len(v)) % 40 % 2
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(len(v), dtype=bool)
    found = sum(got[i]["n_links"] for i in range(len(v)))
    assert found >= 0.9 * link.sum() and all(got[i]["n_links"] <= link[i].sum() for i in range(len(v)))
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in (900, 901, 902, 903))


def test_embeddings_in_many_tiles(spark):
    """Text labels, buckets of many tiles, repeated rows, lengths that differ, huge and tiny components."""
    x = rng.standard_normal((30, 8))
    v = np.concatenate([x[i % 30] + 0.05 * rng.standard_normal((1, 8)) for i in range(240)])
    rows = [(i, r.tolist(), "ab"[i % 2]) for i, r in enumerate(v)] + [(5, v[5].tolist(), "b"), (300, (v[7] * 1e200).tolist(), "b"), (301, (v[7] * 1e-200).tolist(), "b")]
    rows += [(310, v[0].tolist()[:7], "a"), (None, v[4].tolist(), "a"), (311, [], "a"), (312, [1.0, None], "a")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label string, row int, rep string")
    got = embeddings.near_duplicates(frame, tile=8).collect()
    full = [(i, np.array(e) / np.abs(e).max(), lab) for i, e, lab in rows if len(e or []) == 8]
    u = np.stack([e / np.linalg.norm(e) for _, e, _ in full])
    label = np.array([lab for *_, lab in full])
    link = (u @ u.T >= 0.93) & (label[:, None] == label) & ~np.eye(len(u), dtype=bool)
    assert len(got) == len(rows) and 0.99 * link.sum() <= sum(r["n_links"] for r in got) <= link.sum()
    assert {r["n_links"] for r in got if r["vec_id"] in (310, 311, 312)} == {0}
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_tables_follow_size():
    for n in (10, 10_000, 10_000_000):
        bits, tables = embeddings.plan_tables(n, 0.93, 0.998)
        assert n / 2**bits <= 512 and 1 - (1 - (1 - np.arccos(0.93) / np.pi) ** bits) ** tables >= 0.998


def test_chat(spark):
    rows = spark.createDataFrame([(1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 2, "ann", "é!")], "conv_id long, turn long, role string, text string")
    got = {r["perspective"]: r for r in chat.rotate(rows).collect()}
    assert got["ann"]["rendered"] == "assistant: hi\nuser bob: \nassistant: é!\n"
    for r in got.values():
        said = [r["rendered"][int(a) : int(b)] for a, b in (m.split(":") for m in r["mask"].split(","))]
        assert said == (["hi", "é!"] if r["perspective"] == "ann" else [""])
    parts = chat.rotate(rows, part_turns=2).where("perspective = 'ann'").orderBy("part").collect()
    assert "".join(p["rendered"] for p in parts) == got["ann"]["rendered"] and parts[1]["start"] == len(parts[0]["rendered"])


def test_chat_keeps_every_turn(spark):
    """Null, tied and repeated turns are lines of their own, and parts stay bounded."""
    made = [(1, None, "ann", "ok"), (1, None, "ann", "ok"), (1, 3, "bob", "no"), (1, 3, "ann", "yes"), (1, 3, "ann", "yes"), (1, 2, " ", None)]
    made += [(None, None, None, "ok")] * 7
    rows = spark.createDataFrame([(*r, 1, 2) for r in made], "conv_id long, turn long, role string, text string, part int, rank int").repartition(4)
    got = chat.rotate(rows, part_turns=2).orderBy("part").collect()
    ann = [r for r in got if r["conv_id"] == 1 and r["perspective"] == "ann"]
    assert "".join(r["rendered"] for r in ann) == "assistant: ok\nassistant: ok\nuser unknown: \nassistant: yes\nassistant: yes\nuser bob: no\n"
    lone = [r for r in got if r["conv_id"] is None]
    assert [r["n_turns"] for r in lone] == [2, 2, 2, 1] and "".join(r["rendered"] for r in lone) == "assistant: ok\n" * 7
    assert max(r["n_turns"] for r in got) <= 2
    assert chat.rotate(rows.limit(0)).count() == 0


def test_winnowing(docs, empty):
    got = {r["doc_id"]: r for r in winnowing.compare(docs, buckets=5).collect()}
    for i, t, *_ in ROWS:
        t, after = t or "", TEXTS[i - 1] or ""
        half = len(t) // 2
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()
    k, w = winnowing.K, winnowing.W
    hashed = docs.select("doc_id", winnowing.gram_hashes(docs["text"]).alias("h")).collect()
    for r in hashed:
        h = r["h"] or []
        places = sorted({max(j for j in range(a, a + w) if h[j] == min(h[a : a + w])) for a in range(len(h) - w + 1)}) if len(h) >= w else (
            [max(j for j in range(len(h)) if h[j] == min(h))] if h else [])
        text = got[r["doc_id"]]["fingerprint"]
        assert [int(x.split(":")[0]) for x in text.split(",") if x] == places
        assert [x.split(":")[1] for x in text.split(",") if x] == [f"{h[p] & (2**64 - 1):X}" for p in places]
    assert k >= 1 and winnowing.compare(empty).count() == 0


def test_winnowing_of_hot_ids(spark):
    """An id, and no id, with many rows: dealt to many ranges, every row followed by exactly one."""
    made = [(7, f"hot {i} text") for i in range(120)] + [(None, f"lone {i} text") for i in range(80)] + [(i, f"own {i} text") for i in range(30)]
    made += [(7, "hot 3 text")] * 2
    rows = spark.createDataFrame([(*r, 1, "x") for r in made], "doc_id long, text string, bucket int, ghost string").repartition(4)
    got = winnowing.with_next(rows, {}, "doc_id", "text", 16).collect()
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in got))) == sorted(map(repr, made))
    assert sorted(r["next_text"] for r in got) == sorted(t for _, t in made)
    after = {r["text"]: r["next_text"] for r in got}
    assert all(after[f"own {i} text"] == f"own {i - 1} text" for i in (*range(9, 30), *range(1, 7)))
    assert after["own 0 text"].startswith("lone") and sum(t.startswith("own 29") for t in after.values()) == 1
    assert winnowing.compare(rows, buckets=16).count() == len(made) and winnowing.compare(rows.limit(1)).first()["near_next"] == 1.0


def test_winnowing_without_spaces(spark):
    letters = list("天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏😀ab")
    passage = "".join(np.random.default_rng(5).choice(letters, 200))
    k, w, n = winnowing.K, winnowing.W, winnowing.TOKEN
    least = passage[: n + w + k - 2]
    texts = [passage, "é12" + passage, passage[:100] + "x" + passage[100:], f"q{least}77777", f"abc 12345{least}zz ü"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in winnowing.compare(rows, buckets=1).collect()}
    assert got[1]["near_next"] > 0.9 and got[2]["near_next"] > 0.7
    prints = {i: {x.split(":")[1] for x in r["fingerprint"].split(",")} for i, r in got.items()}
    assert prints[0] & prints[3] and prints[3] & prints[4]
    want = {"one two": ["one", "two"], "a" * 12: ["a" * 12], "b abcdefghijkl😀\nc": ["b", "abcdefghijkl", "bcdefghijkl😀", "c"], "😀é ": ["😀é"]}
    found = spark.createDataFrame([(t,) for t in want], "text string")
    assert {r["text"]: r["t"] for r in found.select("text", winnowing.tokens(found["text"]).alias("t")).collect()} == want


def test_packing_gives_easy_words_to_the_model():
    """Ids are those of the whole library, and easy words do not pass its text stages."""
    encoder = packing.WordEncoder(packing.VOCABULARY)
    easy = ["the", "Word", "WORD,", "ende.", "a!", "zqxjkv?", "I", "naive;", "endoftext"]
    hard = ["naïve", "it's", "a1", "x,y", "end..", "K", "<|endoftext|>", "İ", "'s", "-", "42", "a<|endoftext|>"]
    mixed = [w for pair in zip(easy, hard) for w in pair] + hard[len(easy):]
    ids, ends = encoder.learn([w.encode() for w in mixed])
    want = [encoder.core.encode(w, add_special_tokens=False).ids for w in mixed]
    assert [part.tolist() for part in np.split(ids, ends[:-1])] == want
    want = [encoder.core.encode(w, add_special_tokens=False).ids for w in easy]
    encoder.core = types.SimpleNamespace(model=encoder.core.model)  # no text stages
    ids, ends = encoder.learn([w.encode() for w in easy])
    assert [part.tolist() for part in np.split(ids, ends[:-1])] == want


def test_components_write_few_files(spark):
    """Small edge tables are not spread over as many files as there are shuffle partitions."""
    keys = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    held = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        chains = spark.range(600).where("id % 6 > 0").selectExpr("id AS a", "id - 1 AS b")
        found = components.components(chains)
        assert len(found.inputFiles()) <= 2
        assert {r["node"]: r["component"] for r in found.collect()} == {i: i - i % 6 for i in range(600)}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
