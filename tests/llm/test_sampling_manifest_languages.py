"""Importance resampling, Merkle manifest and language identification against
brute force on small tables."""

import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rxlake.llm import catalog, languages, manifest, targets

MEDIUM = "/root/testdata/sf0.01"
LONG = "\n".join(" ".join(f"w{i % 97}x{j}" for i in range(300)) for j in range(40))
EDGES = [
    (1, None), (2, ""), (3, " \n\t \n"), (4, "One two"), (5, LONG), (6, LONG), (6, LONG), (7, "a-b\nA b\n\nc"), (None, "a-b\nA b\n\nc"),
    (8, "Ünïcode wörds ñ\n漢字 42 \x0b end " + "long" * 60), (9, "same line\n" * 50), (10, "x\ny\nz\n" * 20),
]
CLASHES = ["rid", "n_words", "lines", "crossing", "line", "n", "a", "b", "bucket", "weight", "score", "rank", "at", "row", "leaf", "group", "tree", "hash", "path", "lang_pred", "_up"]


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def key(r):
    return [(v is None, str(type(v)), v if v is not None else 0) for _, v in sorted(r.items())]


# ---- importance resampling
def brute_resample(rows, wanted, percent=5):
    def grams(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        out = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(g.encode()) % 10_000 for g in out]

    source, target = np.zeros(10_000, int), np.zeros(10_000, int)
    of = [grams(t) for _, t in rows]
    for _, g in of:
        np.add.at(source, g, 1)
    for t in wanted:
        np.add.at(target, grams(t)[1], 1)
    a, b = int(target.sum()) + 10_000, int(source.sum()) + 10_000
    gain = [math.floor(1000 * math.log(float((int(t) + 1) * b) / float((int(s) + 1) * a))) for s, t in zip(source, target)]
    out = []
    for (i, _), (n, g) in zip(rows, of):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in g)
        out.append({"doc_id": i, "n_features": len(g), "weight": weight, "score": weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), "n": n})
    able = sorted((r for r in out if r["n"] >= 20), key=lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"] or 0))
    take = len(able) * percent // 100
    for k, r in enumerate(able):
        r["rank"] = k + 1 if k < take else None
    return sorted(({**{k: v for k, v in r.items() if k != "n"}, "rank": r.get("rank")} for r in out), key=key)


@pytest.mark.parametrize("chunk", [8 << 20, 200])
def test_resampling_matches_brute_force(spark, make_docs, monkeypatch, chunk):
    monkeypatch.setattr(targets, "CHUNK_BYTES", chunk)
    rng = np.random.default_rng(1)
    rows = [(100 + i, "".join(f"{'Word' if x % 3 else 'w'}{x}{chr(10) if x % 7 == 0 else ', '}" for x in rng.geometric(0.05, rng.integers(0, 80)))) for i in range(150)]
    rows = [*rows, *EDGES, (500, "hot line of words\n" * 3 + "tail"), *[(600 + k, "hot line of words\nhot line of words") for k in range(60)]]
    wanted = ["w1 w2 Word4 hot line", None, "one two\nsame LINE", LONG[:2000]]
    target = spark.createDataFrame([(k, t) for k, t in enumerate(wanted)], "item_id long, text string")
    docs = make_docs(rows).repartition(3)
    for percent in (5, 50):
        assert sorted(rows_of(targets.resample(docs, target, percent=percent)), key=key) == brute_resample(rows, wanted, percent)


def test_resampling_edges(spark, make_docs):
    target = spark.createDataFrame([("a b",)], "text string")
    assert targets.resample(make_docs(EDGES).filter("false"), target).count() == 0
    rows = [(k, LONG if k % 3 else "few words") for k in range(90)]
    got = rows_of(targets.resample(make_docs(rows), target.filter("false"), percent=10))
    assert sorted(got, key=key) == brute_resample(rows, [], 10)
    plain = make_docs(EDGES, extra=False)
    crowded = plain.withColumns({c: F.lit("x") for c in CLASHES})
    a, b = (sorted(rows_of(targets.resample(d, target)), key=key) for d in (plain, crowded))
    assert a == b == brute_resample(EDGES, ["a b"])


def test_crc_of_joined_words():
    words = [b"", b"a", b"word", b"\xc3\xa9t\xc3\xa9", b"x" * 64, b"y" * 65, b"z" * 1000]
    pairs = list(itertools.product(words, words))
    left, right = (np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1))
    got = targets.joined_crc(left, right, np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    assert targets.word_crcs(data, np.cumsum(sizes) - sizes, sizes).tolist() == [zlib.crc32(w) for w in words]


# ---- Merkle manifest
def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""

    def H(s):
        return hashlib.sha256(s.encode()).hexdigest()

    def leaf(i, source, lang, n, text):
        parts = [None if i is None else str(i), source, lang, None if n is None else str(n), text]
        return H("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))

    def tree(hashes):
        """(root, per leaf: list of (sibling or None, sibling stands left))."""
        steps = [[] for _ in hashes]
        at, level = list(range(len(hashes))), list(hashes)
        while len(level) > 1:
            for k in range(len(hashes)):
                other = at[k] ^ 1
                steps[k].append((level[other] if other < len(level) else None, at[k] % 2 == 1))
                at[k] //= 2
            level = [H("".join(level[j : j + 2])) for j in range(0, len(level), 2)]
        return (level or [None])[0], steps

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, paths = {}, {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        subs[g], paths[g] = tree([leaf(*r) for r in groups[g]])
    root, tops = tree([subs[g] for g in order])
    out = []
    for t, g in enumerate(order):
        for r, path in zip(groups[g], paths[g]):
            tampered = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 0 and r[3] is not None
            node = leaf(*r[:3], r[3] + 1, r[4]) if tampered else leaf(*r)
            whole = [*path, *tops[t]]
            for sibling, left in whole:
                node = H(node if sibling is None else sibling + node if left else node + sibling)
            out.append({
                "doc_id": r[0], "leaf": leaf(*r), "subroot": subs[g], "root": root, "proof_sha256": H("".join(s or "" for s, _ in whole)),
                "folded_root": node, "verified": node == root,
            })
    return sorted(out, key=key)


SHAPES = [
    [],
    [(1, "s", "en", 5, "alone")],
    [(i, "s", None, i, f"t{i}") for i in range(3)],
    [(i, f"s{i % 3}", ["en", "fr", None, "é", "z", "Z"][i % 6 if i % 2 else 0], None if i % 11 == 0 else i, f"text {i} ñ") for i in range(77)]
    + [(5, "s", "en", 1, "other"), (5, "s", "en", 1, "other"), (None, None, None, None, None), (None, None, "en", 2, ""), (200, "s", "one", 3, LONG)],
]


@pytest.mark.parametrize("rows", SHAPES, ids=range(len(SHAPES)))
def test_manifest_matches_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    crowded = docs.withColumns({c: F.lit("x") for c in CLASHES})
    change = {"n_chars": F.col("n_chars") + F.when(catalog.bucket_of("doc_id", 7) == 0, 1).otherwise(0)}
    got = sorted(rows_of(manifest.manifest(crowded, tampered=change)), key=key)
    assert got == brute_manifest(rows)
    assert all(r["verified"] for r in rows_of(manifest.manifest(docs))) and len(got) == len(rows)


# ---- language identification
def brute_probability(text, probability):
    """Sum over all cuts of the text into pieces, by recursion."""
    if not text:
        return 1.0
    return sum(probability[text[:n]] * brute_probability(text[n:], probability) for n in range(1, len(text) + 1) if text[:n] in probability)


def test_forward_sums_all_segmentations(monkeypatch):
    monkeypatch.setattr(languages, "UNITS", 3)
    rng = np.random.default_rng(0)
    pieces = languages.Pieces([b" a", b"ab", b"abc", b" ab", b"ca", b"bca", "é".encode(), "aé".encode()])
    p = rng.random((len(pieces.texts), 2))
    p /= p.sum(axis=0)
    words = ["abc", "abcab", "aéca", "cab", "b", "漢", "abcabcabcé"]
    import pyarrow as pa

    units, sizes, owner = languages.units_of(pa.array(words))
    assert owner.tolist() == list(range(len(words)))
    got = languages.forward(pieces, languages._scaled(pieces, p), units, sizes)
    uses = languages.expected(pieces, languages._scaled(pieces, p), units, sizes, np.eye(len(words), 2))
    for g in range(2):
        table = dict(zip(pieces.texts, p[:, g]))
        for k, w in enumerate(words):
            assert math.isclose(got[k, g], math.log(brute_probability(f" {w}".encode(), table)), rel_tol=1e-9)
        # expected uses: derivative of the log-probability by the log of a piece's probability
        for at, t in enumerate(pieces.texts):
            if t in f" {words[g]}".encode():
                more = dict(table)
                more[t] *= 1 + 1e-6
                slope = (math.log(brute_probability(f" {words[g]}".encode(), more)) - math.log(brute_probability(f" {words[g]}".encode(), table))) / 1e-6
                assert abs(uses[at, g] - slope) < 1e-4


def test_units_of_words():
    import pyarrow as pa

    units, sizes, owner = languages.units_of(pa.array(["It's", "42", "", "ÉTÉ!!", "x" * 70, "हिन्दी", "́"]))
    texts = [bytes(u[:n]).decode() for u, n in zip(units, sizes)]
    assert list(zip(owner.tolist(), texts)) == [(0, " it"), (0, " s"), (3, " été"), (4, " " + "x" * 30), (4, "x" * 30), (4, "x" * 10), (5, " हिन्दी")]
    assert len(languages.units_of(pa.array([], pa.string()))[1]) == 0


def test_languages_on_held_out_rows(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in catalog.op13_marginalised_langid(spark, MEDIUM).collect() if r["held_out"]]
    assert len(held) > 200 and np.mean([r["lang_pred"] == docs[r["doc_id"]] for r in held]) > 0.98


def test_languages_match_a_plain_model(spark, make_docs, monkeypatch):
    monkeypatch.setattr(languages, "CHUNK_BYTES", 300)
    monkeypatch.setattr(languages, "GROUP", 2)
    base = {"en": "the cat sat on the mat", "fr": "le chat est sur la table", "de": "die katze sitzt auf der matte"}
    rows = [(i, " ".join(t.split()[i % 4 :]), lang) for i in range(12) for lang, t in base.items()]
    learn = make_docs([(i, t) for i, t, _ in rows], extra=False).drop("lang").withColumn("k", F.monotonically_increasing_id())
    tags = spark.createDataFrame([(i, t, lang) for i, t, lang in [*rows, (90, "x", None), (91, None, "en"), (92, "42 !", "fr")]], "doc_id long, text string, lang string")
    model = languages.train(tags.repartition(4))
    assert model.names == ("de", "en", "fr") and np.allclose(model.pieces.sum(axis=0), 1) and math.isclose(math.exp(model.prior[1]), 13 / 38)
    pieces = languages.load_pieces()
    tables = [dict(zip(pieces.texts, model.pieces[:, g])) for g in range(3)]
    asked = [(1, "the cat"), (2, "le  CHAT, est!"), (3, None), (4, ""), (5, "42 -- 7"), (6, "katze " * 3000), (6, "katze " * 3000), (None, "table"), (7, "漢字")]
    crowded = make_docs(asked).withColumns({c: F.lit("x") for c in CLASHES if c != "row"})
    got = [(r["row"]["doc_id"], r["lang_pred"], r["score"]) for r in languages.identify(crowded, model).collect()]
    assert len(got) == len(asked)
    for i, lang, score in got:
        text = next(t for k, t in asked if k == i) or ""
        units = re.findall(r"[^\W\d_]+", text.lower())
        if not units:
            assert (lang, score) == ("und", 0.0)
            continue
        logs = [model.prior[g] + sum(math.log(brute_probability(f" {u}".encode(), tables[g])) * units.count(u) for u in set(units)) for g in range(3)]
        assert lang == model.names[int(np.argmax(logs))]
        assert abs(score - 1 / sum(math.exp(x - max(logs)) for x in logs)) < 1e-6
    assert learn.count() == len(rows)


def test_languages_without_rows(spark, make_docs):
    none = spark.createDataFrame([], "text string, lang string")
    model = languages.train(none)
    got = languages.identify(make_docs([(1, "some text"), (2, None)]), model).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2
    assert languages.identify(make_docs([(1, "x")]).filter("false"), model).count() == 0
