"""Training-data operators against brute force on small tables."""

import hashlib
import math
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rxlake.llm import catalog, chat, components, embeddings, exact, licences, mixing, ngrams, packing, quality, simhash, substrings

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"w{i % 977}x" for i in range(30_000))
EDGES = [(1, None), (2, ""), (3, "  \t\n "), (4, "one two"), (5, LONG), (6, LONG), (6, LONG), (7, "a b c d e f"), (None, "a b c d e f"), (8, "Ünïcode wörds ñ 漢字 \x0b end")]


def words(text):
    return (text or "").encode().split()


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# ---- exact dedup
def test_exact_edges(make_docs):
    got = rows_of(exact.exact_groups(make_docs(EDGES)))
    groups = {}
    for i, t in EDGES:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(EDGES)
    for r in got:
        text = next(t or "" for t, ids in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        ids = groups[text]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max(i for i in ids if i is not None)
    assert sum(r["kept"] for r in got) == len(groups)


def test_exact_hot_group_is_salted(make_docs):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(600)]
    got = rows_of(exact.exact_groups(make_docs(rows)))
    hot = [r for r in got if r["group_size"] > 1]
    assert {(r["keep_id"], r["group_size"]) for r in hot} == {(599, 400)}
    assert [r["doc_id"] for r in hot if r["kept"]] == [599]
    kept = exact.exact_dedup(make_docs(rows))
    assert kept.columns == make_docs(rows).columns and kept.count() == 201


def test_empty_tables(make_docs):
    none = make_docs([(1, "x")]).filter("doc_id = 0")
    for df in (
        exact.exact_groups(none), simhash.simhash_components(none), packing.pack(none), mixing.mixed_sizes(none), licences.scan(none),
        substrings.substring_dedup(none), ngrams.score(none), mixing.mixed_documents(none), simhash.simhash_dedup(none),
    ):
        assert df.count() == 0


# ---- components
CLASHES = [
    "_id", "_kept", "_copies", "_use", "_text", "_h", "_hot", "_salt", "_lead", "_top", "_rank", "_run", "_stats", "_tokens", "_lines", "_n", "_s",
    "row", "id", "fp", "low", "component_id", "size", "target", "taken", "sid", "slot", "order", "chunk", "block", "rid", "doc", "word", "words",
    "n_words", "score", "predicted", "held_out", "start", "length", "ids", "label", "keep_id", "group_size", "kept", "count", "key", "pos",
]


@pytest.mark.parametrize(
    "operator",
    [
        lambda d: exact.exact_groups(d), lambda d: exact.exact_dedup(d).select("doc_id", "text"),
        lambda d: simhash.simhash_components(d), lambda d: simhash.simhash_dedup(d).select("doc_id", "text"),
        lambda d: mixing.mixed_sizes(d).drop("rid"), lambda d: mixing.mixed_documents(d).select("doc_id", "text"),
        lambda d: quality.classify(d, quality.RuleModel(0.5, ())).select("row.doc_id", "score", "predicted"),
        lambda d: packing.with_crc(packing.pack(d.coalesce(1))), lambda d: substrings.substring_dedup(d, window=20),
        lambda d: licences.scan(d),
    ],
)
def test_clashing_columns_change_nothing(make_docs, operator):
    rows = [(1, LONG, "s"), (2, LONG, "t"), (3, "a b c", "s"), (None, None, None), (4, "", "t")]
    plain = make_docs(rows, extra=False).coalesce(1)
    crowded = plain.withColumns({c: F.lit("x") for c in CLASHES})
    values = [sorted(map(repr, operator(d).collect())) for d in (plain, crowded)]
    assert values[0] == values[1]


def test_components_match_union_find(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(500 + i, 501 + i) for i in range(40)] + [(900, 901 + i) for i in range(50)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame([*pairs, (None, 4)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.connected_components(df, "a", "b").collect()}
    assert got == {n: find(n) for a, b in pairs if a != b for n in (a, b)}


# ---- SimHash
def brute_fingerprint(text):
    w = [x.lower() for x in words(text)]
    k = min(4, len(w))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def test_simhash_matches_brute_force(make_docs, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)  # tiles and the forest of links act on a small table
    monkeypatch.setattr(simhash, "LINKS", 4)
    base = [f"t{i}" for i in range(400)]
    rows = [*EDGES]
    for k in range(60):
        w = list(base)
        w[(7 * k) % 400] = f"changed{k}"
        rows.append((100 + k, " ".join(w)))
    got = {(r["id"], r["fp"]): r["component_id"] for r in simhash.simhash_components(make_docs(rows)).collect()}
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a][1] ^ fps[b][1]).count("1") <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    for k, (i, fp) in enumerate(fps):
        members = [fps[j][0] for j in range(len(fps)) if find(j) == find(k) and fps[j][0] is not None]
        assert got[(i, fp - (1 << 64) if fp >> 63 else fp)] == (min(members) if members else None)


# ---- packing
@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=80))
def test_packer_keeps_every_id_once(sizes):
    p = packing.Packer(64, 0)
    docs = [np.arange(n, dtype=np.uint32) + 1000 * k for k, n in enumerate(sizes)]
    for k, d in enumerate(docs):
        p.add(k, d)
    p.join_open(last=True)
    out = p.taken()
    back = {}
    fill = {}
    for doc, start, length, ids, total, seq, offset in out:
        back.setdefault(doc, []).append((start, np.frombuffer(ids, np.uint32)))
        assert total == sizes[doc] and fill.get(seq, 0) == offset
        fill[seq] = offset + length
    for k, d in enumerate(docs):
        assert np.array_equal(np.concatenate([x for _, x in sorted(back[k], key=lambda t: t[0])]), d)
    assert all(f <= 64 for f in fill.values()) and sum(f < 64 for f in fill.values()) <= 1


def test_packed_ids_equal_the_tokenizer(make_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = [*[r for r in EDGES if r[0] not in (6, None)], (20, "á <|endoftext|>b 's it's x y\x85z Å"), (21, "don't 12a \n\n x")]
    got = packing.pack(make_docs(rows)).orderBy("doc_id", "start").collect()
    for i, t in rows:
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in got if r["doc_id"] == i])
        assert ids.tolist() == [*tok.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
    crc = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.with_crc(packing.pack(make_docs(rows))).collect()}
    assert crc == {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in got}


# ---- mixing
def brute_targets(sizes):
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixing_targets_and_limits(make_docs):
    rows = [(i, " ".join(["w"] * (i % 37)), ["a", "b", "c", None, "tiny", "tiny2"][0 if i % 3 else (i // 3) % 6]) for i in range(900)]
    rows += [(2000, None, "empty"), (2001, "x y", "tiny"), (2001, "x y", "tiny"), (None, "q r s", "b")]
    got = rows_of(mixing.mixed_sizes(make_docs(rows)))
    assert len(got) == len(rows)
    source = {}
    for i, t, s in rows:
        source[s] = source.get(s, 0) + len(words(t))
    want = brute_targets(source)
    by = {}
    for r in got:
        by.setdefault((r["source_size"], round(r["target"], 6)), 0)
        by[(r["source_size"], round(r["target"], 6))] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert {k[1] for k in by} == {round(t, 6) for t in want.values()}
    for (_, target), taken in by.items():
        assert abs(taken - target) <= max(20, 0.01 * target)
    again = rows_of(mixing.mixed_sizes(make_docs(rows)))
    key = lambda r: (r["doc_id"] or -1, r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.mixed_documents(make_docs(rows))
    assert mixed.columns == make_docs(rows).columns and mixed.filter("doc_id = 2000").count() == 1


def test_schedule_is_low_discrepancy(spark):
    src = spark.createDataFrame([(1, 500, 1000.0, 50), (2, 900, 300.0, 90), (3, 10, 30.0, 1), (4, 0, 0.0, 0)], "sid int, source_size long, target double, blocks long")
    slots = mixing.schedule(src).orderBy("slot").collect()
    assert len({r["slot"] for r in slots}) == len(slots)
    for sid, want in ((1, 100), (2, 30), (3, 3)):
        mine = [r for r in slots if r["sid"] == sid]
        assert abs(len(mine) - want) <= 4 and max(r["use"] for r in mine) < mixing.MOST_USES


def discrepancy(order, share):
    """Largest distance, over all prefixes, of a source's slots from its share."""
    count, worst = dict.fromkeys(share, 0), 0.0
    for k, sid in enumerate(order, 1):
        count[sid] += 1
        worst = max(worst, *[abs(count[s] - k * share[s]) for s in share])
    return worst


def test_every_prefix_of_the_mix_holds_each_source_in_its_share(spark):
    want = {1: 300, 2: 120, 3: 60, 4: 30}
    src = spark.createDataFrame([(s, n * 10, float(n * 10), n) for s, n in want.items()], "sid int, source_size long, target double, blocks long")
    slots = [(r["slot"], r["sid"]) for r in mixing.schedule(src).collect()]
    order = [sid for slot, sid in sorted(slots) if slot < sum(want.values())]  # what follows tops up the rounding rest
    assert len(slots) - len(order) <= 2 * len(want)
    share = {s: n / sum(want.values()) for s, n in want.items()}
    bound = 2 * (math.log2(len(order)) + 1)  # two ends of an interval, one per binary digit
    assert discrepancy(order, share) <= bound
    assert discrepancy(sorted(order), share) > 3 * bound  # source after source
    assert discrepancy([s for k in range(300) for s in want if k < want[s]], share) > 2 * bound  # block after block in turn


def test_mixed_documents_come_in_the_order_of_the_mix(spark, make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT_BITS", 10)
    rows = [(k, "w " * 20, "abcd"[0 if k % 2 else (k // 2) % 4]) for k in range(800)]
    docs = make_docs(rows)
    sizes = {r["doc_id"]: r for r in mixing.mixed_sizes(docs).collect()}
    assert all((r["first_slot"] is None) == (r["taken"] == 0) == (r["n_slots"] == 0) for r in sizes.values())
    mixed = mixing.mixed_documents(docs)
    got = [r["doc_id"] for r in mixed.select("doc_id").collect()]  # partitions in order
    seen = [d for k, d in enumerate(got) if d not in got[:k]]
    firsts = [sizes[d]["first_slot"] for d in seen]
    assert firsts == sorted(firsts)
    total = sum(sizes[d]["size"] for d in got)
    source = {k: s for k, _, s in rows}
    share = {s: sum(sizes[d]["size"] for d in got if source[d] == s) / total for s in "abcd"}
    order = [source[d] for d in got]
    assert discrepancy(order, share) <= 2 * (math.log2(len(order)) + 2)
    assert discrepancy(sorted(order), share) > 50


def test_every_small_source_reaches_its_target(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT_BITS", 8)
    rows = [(k, "w " * 500, f"big{k % 4}") for k in range(120)]
    rows += [(1000 + k, "w " * (1 + k % 5), f"small{k:03d}") for k in range(600)]
    got = rows_of(mixing.mixed_sizes(make_docs(rows)))
    source, of = {}, {i: s for i, _, s in rows}
    for i, t, s in rows:
        source[s] = source.get(s, 0) + len(words(t))
    want, taken = brute_targets(source), dict.fromkeys(source, 0)
    for r in got:
        taken[of[r["doc_id"]]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - want[s]) < 0.501 for s in source)
    uses = {r["doc_id"]: r["n"] for r in rows_of(mixing.mixed_documents(make_docs(rows)).groupBy("doc_id").agg(F.count("*").alias("n")))}
    assert all(uses.get(1000 + k) == 3 for k in range(600))
    src = make_docs(rows).sparkSession.createDataFrame([(k, 10, 30.0 if k % 2 else 0.2, 1) for k in range(1, 2001)], "sid int, source_size long, target double, blocks long")
    slots = mixing.schedule(src).collect()
    assert len({r["slot"] for r in slots}) == len(slots) == 3000


# ---- quality
def test_quality_on_held_out_rows(spark):
    got = catalog.op3_quality_rules(spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(got) > 50 and np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95


def test_quality_edges(spark, make_docs):
    labelled = make_docs(EDGES, extra=False).withColumn("quality", F.lit(1))
    one = quality.fit_rules(labelled)
    assert not one.rules and one.intercept > 0
    assert quality.fit_rules(labelled.filter("false")).intercept == 0
    rows = [(i, "THIS IS!! LOUD!! " * 20 if i % 2 else "a calm line of prose. " * 20) for i in range(60)]
    model = quality.fit_rules(make_docs(rows, extra=False).withColumn("quality", (F.col("doc_id") % 2 == 0).cast("int")))
    out = quality.classify(make_docs([*rows, *EDGES]), model)
    got = out.select("row.doc_id", "score", "predicted").collect()
    assert len(got) == len(rows) + len(EDGES) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["doc_id"] % 2 == 0) for r in got[: len(rows)])


# ---- licences
def test_licences_found_and_verified(make_docs):
    mit = licences.TEMPLATES["MIT"]
    cut = mit.split()
    rows = [
        (1, f"{'lorem ipsum ' * 300}# {mit}{' dolor sit' * 300}"),
        (2, "foo. Released under the MIT License. bar"),
        (3, "released under the license of mit"),
        (4, " ".join(cut[: len(cut) // 2])),
        (5, " ".join([*cut[:40], "changed", *cut[41:]])),
        *[(10 + k, f"x y z {t}") for k, t in enumerate(licences.TEMPLATES.values())],
        *EDGES,
    ]
    got = {(r["doc_id"], r["licence"]): r["containment"] for r in licences.scan(make_docs(rows)).collect()}
    assert got[(1, "MIT")] == 1.0 and got[(2, "MIT-notice")] == 1.0 and 0.8 <= got[(5, "MIT")] < 1.0
    assert not [k for k in got if k[0] in (3, 4, 7)]
    for k, name in enumerate(licences.TEMPLATES):
        assert got[(10 + k, name)] == 1.0
    assert min(licences.collision_probability(len(licences._shingles(t))) for t in licences.TEMPLATES.values()) > 0.999


# ---- chat
def test_quotes_are_linked_and_removed(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?\n\nIt is long."),
        (1, 1, "assistant", "Use sorted().\nIt is stable."),
        (1, 2, "user", "> How do I SORT   a list?\nAn aside."),
        (1, 3, "user", "Ann wrote:\n> > How do I sort a list?\n> Use sorted().\n> It is stable.\nThanks!"),
        (1, 4, "assistant", "> never said\nWhat?"),
        (1, 5, None, None),
        (None, None, "user", "> How do I sort a list?"),
        (2, 0, "user", "> Use sorted()."),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("row", F.lit(1)).withColumn("at", F.lit(1))
    got = {(r["conv_id"], r["turn"]): r for r in chat.link_quotes(df).collect()}
    assert len(got) == len(rows)
    assert got[(1, 2)]["reply_to"] == 0 and got[(1, 2)]["text"] == "An aside."
    assert got[(1, 3)]["reply_to"] == 1 and got[(1, 3)]["quote_levels"] == 2 and got[(1, 3)]["text"] == "Thanks!" and got[(1, 3)]["n_linked"] == 2
    assert got[(1, 4)]["reply_to"] is None and got[(1, 4)]["n_quotes"] == 1
    assert [got[(1, t)]["root_turn"] for t in range(6)] == [0, 1, 0, 1, 4, 5]
    assert sorted(range(6), key=lambda t: got[(1, t)]["position"]) == [0, 2, 1, 3, 4, 5]
    assert got[(2, 0)]["reply_to"] is None and got[(2, 0)]["text"] == ""


def test_chat_without_quotes_keeps_turn_order(spark):
    got = catalog.op6_quotation_linking(spark, SMALL).collect()
    assert len(got) == spark.read.parquet(f"{SMALL}/conversations.parquet").count()
    for r in got:
        assert r["position"] == r["turn"] and r["turn_text"].startswith(f"<|{r['role']}|>\n")


# ---- language model
def test_elias_fano_and_levels_round_trip():
    rng = np.random.default_rng(2)
    for values in (np.sort(rng.integers(0, 10_000, 3000)), np.zeros(5, np.int64), np.array([7]), np.arange(100) * 1_000_003):
        assert np.array_equal(ngrams.EliasFano.of(values).get(np.arange(len(values))), values)
    pairs = np.unique(rng.integers(0, [60, 500], (900, 2)), axis=0)
    pairs = pairs[pairs[:, 0] % 3 > 0]
    level = ngrams.Level.of(pairs[:, 0], pairs[:, 1], 61)
    asked = np.concatenate([pairs, rng.integers(0, [60, 500], (500, 2))])
    where = {tuple(p): k for k, p in enumerate(pairs.tolist())}
    assert level.find(asked[:, 0], asked[:, 1]).tolist() == [where.get(tuple(p), -1) for p in asked.tolist()]


def test_lm_counts_and_normalisation(spark, make_docs):
    rng = np.random.default_rng(3)
    vocab = ["the", "cat", "sat", "on", "mat", "A", "dog", "ran"]
    rows = [(i, " ".join(rng.choice(vocab, size=rng.integers(0, 12), p=[0.3, 0.2, 0.15, 0.1, 0.1, 0.05, 0.05, 0.05]))) for i in range(300)] + EDGES
    got = rows_of(ngrams.score(make_docs(rows)))
    count, tokens = {}, {}
    for k, (i, t) in enumerate(rows):
        tokens[k] = [*[w.lower() for w in words(t)], None]
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            for w in tokens[k]:
                count[w] = count.get(w, 0) + 1
    total, z = sum(count.values()), math.log10(sum(count.values()) + 0.1 * (len(count) + 1))
    want = sorted((i if i is not None else -1, len(tokens[k]), sum(w in count for w in tokens[k]), round(sum(math.log10(count.get(w, 0) + 0.1) - z for w in tokens[k]), 4)) for k, (i, _) in enumerate(rows))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {total}
    # the probabilities of all continuations of any context sum to one
    train_docs = make_docs(rows).filter("pmod(crc32(cast(cast(coalesce(cast(doc_id as string), '') as string) as binary)), 10) <> 0").select("text")
    block, _, n, v = ngrams.train(train_docs.fillna("", ["text"]))
    trie = ngrams.Trie(ngrams.map_levels(block))
    uni = (trie.counts + ngrams.ADD) / (n + ngrams.ADD * (v + 1))
    other = 1.0 - uni[np.arange(len(uni)) != trie.start].sum()
    for context in ([trie.start], [trie.start, 0], [0, 1], [1, -1], [2, 0], [-1]):
        p = 0.0
        for w in [*range(len(trie.hashes)), trie.end, -1]:
            weight, open_ = trie.score(np.array([*context, w]))
            p += 10 ** weight[-1] * ((other if w < 0 else uni[w]) if open_[-1] else 1.0)
        assert abs(p - 1) < 1e-2


@pytest.mark.parametrize("level", [1 << 18, 16])
def test_lm_keeps_every_ngram_from_a_fixed_count(make_docs, monkeypatch, level):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in np.minimum(rng.geometric(0.08, rng.integers(0, 40)), 60))) for i in range(400)]
    rows += [(k + 1000, "very rare words here") for k in range(6)] + [(2000, None), (2001, "unseen")]
    train_docs = make_docs([r for r in rows if zlib.crc32(str(r[0]).encode()) % 10]).fillna("", ["text"]).select("text")
    block, _, n, v = ngrams.train(train_docs)  # few tokens: from MIN_COUNT, in one block
    trie = ngrams.Trie(ngrams.map_levels(block))
    monkeypatch.setattr(ngrams, "LEVEL_SIZE", level)  # 16: most words are rare
    monkeypatch.setattr(ngrams, "SHARD_TOKENS", 300)  # words are split over shards
    got = {r["doc_id"]: r["score"] for r in rows_of(ngrams.score(make_docs(rows)))}
    z = math.log10(n + ngrams.ADD * (v + 1))
    count = {}
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            for w in words(t):
                count[w] = count.get(w, 0) + 1
    for i, t in rows:
        hashes = np.array([ngrams.xxhash.xxh64_intdigest(w) for w in words(t)], np.uint64).view(np.int64)
        weight, uni = trie.score(np.concatenate([[trie.start], trie.word_ids(hashes), [trie.end]]).astype(np.int64))
        c = np.array([*[count.get(w, 0) for w in words(t)], trie.counts[-1]])
        want = weight[1:].sum() + (uni[1:] * (np.log10(c + ngrams.ADD) - z)).sum()
        assert abs(got[i] - want) < 0.01


@pytest.mark.parametrize(("conf", "value"), [("spark.sql.shuffle.partitions", "24"), ("spark.sql.execution.arrow.maxBytesPerBatch", "3000b")])
def test_lm_rare_words_meet_their_counts(spark, make_docs, conf, value):
    # 6 shards (no power of two); batches that end by their bytes
    rows = [(i, f"often rare{i % 150} only{i} " + "pad " * (i % 60)) for i in range(300)]
    docs, before = make_docs(rows), spark.conf.get(conf, None)
    spark.conf.set(conf, value)
    try:
        got = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows_of(ngrams.score(docs)))
    finally:
        spark.conf.unset(conf) if before is None else spark.conf.set(conf, before)
    count = {}
    for i, t in rows:
        for w in [*t.split(), None] if zlib.crc32(str(i).encode()) % 10 else []:
            count[w] = count.get(w, 0) + 1
    n, z = sum(count.values()), math.log10(sum(count.values()) + 0.1 * (len(count) + 1))
    want = [(i, w, [*t.split(), None]) for i, t in rows for w in [len(t.split()) + 1]]
    assert got == [(i, w, sum(x in count for x in k), n, round(sum(math.log10(count.get(x, 0) + 0.1) - z for x in k), 4)) for i, w, k in want]


def test_lm_beats_the_base_on_held_out_rows(spark):
    got = catalog.op7_elias_fano_lm(spark, MEDIUM).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


# ---- embeddings
def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_BYTES", 2048)
    monkeypatch.setattr(embeddings, "LEAF", 4)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base, base[:20] + rng.normal(size=(20, 16)) * 0.15, np.repeat(base[:1], 30, axis=0), base[5:6] * 1e-200, base[6:7] * 1e200])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(900, None), (901, [0.0] * 16), (902, [1.0, None] + [0.0] * 14), (903, [float("nan")] * 16), (904, [float("inf")] * 16), (905, []), (None, base[3].tolist())]
    df = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>").withColumn("node", F.lit(1)).withColumn("block", F.lit(2))
    got = embeddings.near_vectors(df).collect()
    full = [*x, base[3]]
    unit = np.array([v / np.abs(v).max() for v in full])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    label = np.arange(len(full))
    while True:
        nxt = np.where(near, label[None, :], len(full)).min(1)
        if (nxt == label).all():
            break
        label = nxt
    ids = [*range(len(x)), None]
    want = {i: (int(near[k].sum()) - 1, int(label[k])) for k, i in enumerate(ids)}
    want |= {b[0]: (0, b[0]) for b in bad[:-1]}
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want and len(got) == len(want)
    assert embeddings.near_vectors(df.filter("false")).count() == 0


def test_most_pairs_are_never_compared_in_full(spark):
    vectors = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    r = embeddings.join_statistics(vectors, cosine=0.9).first()
    assert r["vectors"] > 400 and 0 < r["compared"] < 0.05 * r["pairs"]
    assert tuple(embeddings.join_statistics(vectors.filter("false")).first()) == (0, 0, 0)


# ---- substrings
def brute_substrings(rows, window):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    seen, out = {}, {}
    for k in order:
        w = words(rows[k][1])
        for s in range(len(w) - window + 1):
            seen.setdefault(tuple(w[s : s + window]), (rows[k], s))
    for k in order:
        w = words(rows[k][1])
        gone = set()
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] != (rows[k], s):
                gone |= set(range(s, s + window))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out[k] = (rows[k][0], len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return sorted(out.values(), key=str)


@pytest.mark.parametrize("hot", [4096, 2])
def test_substrings_match_brute_force(make_docs, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_RUNS", hot)  # 2: windows of common anchors go singly
    monkeypatch.setattr(substrings, "INDEX_SYMBOLS", 200)  # several indexes per task
    rng = np.random.default_rng(6)
    passage = [f"p{i}" for i in range(45)]
    rows = []
    for i in range(60):
        w = [f"r{x}" for x in rng.integers(0, 40, rng.integers(0, 90))]
        at = int(rng.integers(0, len(w) + 1))
        rows.append((i, " ".join([*w[:at], *passage[int(rng.integers(0, 20)) :], *w[at:]])))
    rows += [(100, "a b " * 40), (101, "z " * 30), (102, rows[3][1]), *EDGES]
    got = rows_of(substrings.substring_dedup(make_docs(rows), window=20))
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=str) == brute_substrings(rows, 20)


@pytest.mark.parametrize("parts", [1, 8])
@pytest.mark.parametrize("hot", [4096, 1])
def test_repeated_rows_keep_what_they_own(make_docs, monkeypatch, hot, parts):
    monkeypatch.setattr(substrings, "HOT_RUNS", hot)
    own, tail, lost = (" ".join(f"{c}{i}" for i in range(60)) for c in "otn")
    rows = [(1, own), (1, own), (2, f"{tail} {own}"), (2, f"{tail} {own}"), (3, "z " * 30), (3, "z " * 30), (None, lost), (None, lost), (4, "few words")]
    got = rows_of(substrings.substring_dedup(make_docs(rows).repartition(parts), window=20))
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=str) == brute_substrings(rows, 20)
    assert sorted((r["doc_id"] or 9, r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, 60), (2, 60), (3, 29), (3, 29), (4, 0), (9, 0), (9, 0)]


# ---- registered queries against SQL
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql_oracles(spark, duck_small, name):
    from oracle import compare

    same, why = compare(catalog.QUERIES[name](spark, SMALL), duck_small, catalog.ORACLES[name])
    assert same, why


def test_pipeline_keeps_the_documents_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SMALL)
        assert kept.columns == docs.columns
    pieces = corpus_pipeline.run(spark, SMALL)
    assert pieces.agg(F.sum("length")).first()[0] > 0
