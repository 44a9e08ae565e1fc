"""Licence scan, quality rules, quotation linking and the pipeline against
plain Python."""

import hashlib
import math
import re
import sys

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from rxlake.llm import catalog, chat, exact, licences, mixing, quality, simhash
from test_llm_operators import EDGES, LONG, brute_fingerprint, words

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ---- licence scan
def brute_licences(rows):
    """Without bands: every window of every text, all templates."""
    found = {}
    for k, (_, text) in enumerate(rows):
        w = [x for x in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if x]
        grams = [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]
        for name, body in licences.TEMPLATES.items():
            t = set(licences._shingles(body))
            n = len(regex.split(r"[^\p{L}\p{N}]+", body.lower().strip(" .\n"))) - 4
            step = licences.stride(n)
            for at in range(0, max(1, len(grams)), step):
                share = len(t & set(grams[at : at + n + step - 1])) / len(t)
                if share >= licences.CONTAINMENT:
                    found[k, name] = max(found.get((k, name), 0.0), share)
    return found


def test_licences_against_a_scan_without_bands(make_docs):
    rng = np.random.default_rng(8)
    names = list(licences.TEMPLATES)
    rows = [(10_000 + k, t) for k, (_, t) in enumerate(EDGES)]
    for k in range(120):
        w = licences.TEMPLATES[names[k % len(names)]].split()
        for _ in range(int(rng.integers(0, 4))):  # a few changed words
            w[int(rng.integers(0, len(w)))] = f"changed{rng.integers(0, 99)}"
        if k % 5 == 0:
            w = w[int(rng.integers(0, len(w) // 3)) :]
        pad = [f"p{x}" for x in rng.integers(0, 500, rng.integers(0, 400))]
        at = int(rng.integers(0, len(pad) + 1))
        rows.append((k, " ".join([*pad[:at], *w, *pad[at:]])))
    rows.append((500, " ".join([licences.TEMPLATES["MIT"], "between the copies"] * 60)))  # one text, many hits
    want = brute_licences(rows)
    ids = {k: r[0] for k, r in enumerate(rows)}
    got = {(r["doc_id"], r["licence"]): r for r in licences.scan(make_docs(rows)).collect()}
    asked = {(ids[k], n): c for (k, n), c in want.items()}
    assert set(got) <= set(asked) and all(got[p]["containment"] <= asked[p] + 1e-12 for p in got)
    assert len(got) >= 0.9 * len(asked) > 50
    assert got[500, "MIT"]["n_windows"] >= 60


# ---- quality rules
def brute_statistics(text):
    t = text or ""
    tokens = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    lines = t.split("\n")
    filled = [x for x in lines if x != ""]
    count = lambda p: len(regex.findall(p, t))
    per = lambda a, b: a / b if b else 0.0
    n = {k: count(p) for k, p in quality.PATTERNS.items()}
    return {
        "words": float(len(tokens)), "word_length": per(len(t), len(tokens)), "upper": per(n["upper"], len(t)), "shouted": per(n["shouts"], len(tokens)),
        "digits": per(n["digits"], len(t)), "symbols": per(n["symbols"], len(t)), "lone_symbols": per(n["lone"], len(tokens)), "stops": per(n["stops"], len(tokens)),
        "line_length": per(len(tokens), len(lines)), "same_lines": 1.0 - len(set(filled)) / len(filled) if filled else 0.0,
        "distinct_words": per(len(set(tokens)), len(tokens)), "markup": per(n["markup"], len(t)),
    }


def brute_score(model, text):
    s = brute_statistics(text)
    total = model.intercept
    for rule, weight in model.rules:
        if all((low is None or s[n] > low) and (high is None or s[n] <= high) for n, low, high in rule.bounds):
            total += weight
    return 1.0 / (1.0 + math.exp(-total))


def test_scores_equal_the_rules_in_plain_python(spark, make_docs):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit_labels(docs, catalog.labels_for_fit(labels))
    assert model.rules
    for df in (docs, make_docs(EDGES)):
        for r in quality.classify(df, model).select("row.text", "score", "predicted").collect():
            assert math.isclose(r["score"], brute_score(model, r["text"]), rel_tol=1e-9) and r["predicted"] == (r["score"] >= 0.5)
    held = {r["doc_id"]: r["score"] for r in catalog.op3_quality_rules(spark, MEDIUM).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert held.keys() == texts.keys() and all(math.isclose(held[i], brute_score(model, texts[i]), rel_tol=1e-9) for i in held)


def test_fit_on_empty_tables_and_repeated_ids(spark, make_docs):
    docs = make_docs([(i, "LOUD!! " * 9 if i % 2 else "calm words here. " * 9) for i in range(40)], extra=False)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    plain = quality.fit_labels(docs, labels)
    assert quality.fit_labels(docs.union(docs), labels.union(labels)) == plain  # repeated rows and labels change nothing
    both = labels.union(spark.createDataFrame([(0, 0), (None, 1), (7, None), (99, 1)], "doc_id long, quality int"))
    assert quality.fit_labels(docs, both.filter("doc_id <> 0 or doc_id is null")) == quality.fit_labels(docs, labels.filter("doc_id <> 0"))
    assert quality.fit_labels(docs, both) == quality.fit_labels(docs.filter("doc_id <> 0"), labels)  # an id with both labels is ignored
    for d, lab in ((docs.filter("false"), labels), (docs, labels.filter("false"))):
        assert quality.fit_labels(d, lab) == quality.RuleModel(0.0, ())
    assert quality.classify(docs.filter("false"), plain).count() == 0


# ---- quotation linking
def plain_links(messages):
    """(conv, turn, role, text) rows -> per row (reply_to, root_turn, levels, quotes, linked, own text)."""

    def lines_of(text):
        out = []
        for line in re.split(r"\r?\n", text or ""):
            marks = regex.match(chat.MARKERS, line)
            marks = marks[0] if marks else ""
            out.append((marks.count(">"), line[len(marks) :].strip(" ")))
        return out

    def norm(p):
        return regex.sub(r"[\s\p{P}$+<=>^`|~]+", " ", p.lower()).strip(" ")

    parsed = []
    for conv, turn, role, text in messages:
        lines = lines_of(text)
        blocks, level, body = [], -1, ""
        for lv, b in [*lines, (-1, "")]:
            if lv == level and b != "":
                body = f"{body}\n{b}" if body else b
            else:
                if body:
                    blocks.append((level, body))
                level, body = lv, b
        own = [b for k, (lv, b) in enumerate(lines) if lv == 0 and not (regex.search(chat.ATTRIBUTION, b) and k + 1 < len(lines) and lines[k + 1][0] > 0)]
        own = re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip(" ")
        quotes = [(lv, norm(b)) for lv, b in blocks if lv > 0]
        parsed.append((conv, turn, own, quotes, [lv for lv, _ in blocks if lv > 0]))
    out = []
    for conv, turn, own, quotes, levels in parsed:
        best, linked, n = None, 0, 0
        for at, (lv, q) in enumerate(quotes):
            if turn is None or not q:
                continue
            n += 1
            found = None
            for c2, t2, own2, _, _ in parsed:
                if c2 == conv and t2 is not None and t2 < turn and q in {norm(x) for x in [own2, *re.split(r"\n\n+", own2), *own2.split("\n")]}:
                    found = t2 if found is None else max(found, t2)
            if found is not None:
                linked += 1
                best = min(best or (lv, at, found), (lv, at, found))
        out.append([conv, turn, best[2] if best else None, max(levels, default=0), n, linked, own])
    first = {}
    for conv, turn, reply, *_ in out:
        if reply is not None:
            first[conv, turn] = min(first.get((conv, turn), reply), reply)
    rows = []
    for conv, turn, reply, levels, n, linked, own in out:
        root = turn
        while (conv, root) in first:
            root = first[conv, root]
        rows.append((conv, turn, reply, root, levels, n, linked, own))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_quotes_against_plain_python(spark, seed):
    rng = np.random.default_rng(seed)
    say = lambda: " ".join(f"w{x}" for x in rng.integers(0, 30, rng.integers(1, 6))) + "."
    rows = []
    for conv in range(12):
        texts = []
        for turn in range(int(rng.integers(1, 9))):
            parts = []
            for _ in range(int(rng.integers(0, 3)) if texts else 0):
                source = texts[int(rng.integers(0, len(texts)))]
                kind = rng.integers(0, 3)
                body = source if kind == 0 else source.split("\n")[0] if kind == 1 else say()
                parts.append("\n".join(f"{'> ' if rng.integers(0, 2) else '>> '[: 2 + kind % 2]}{x.upper() if kind else x}" for x in body.split("\n")))
            parts.append("\n".join([say(), *([say()] if rng.integers(0, 2) else [])]))
            if rng.integers(0, 3) == 0:
                parts.append(say())
            texts.append("\n\n".join(parts))
            rows.append((conv, turn, "user" if turn % 2 else "assistant", texts[-1]))
    rows += [(None, 0, "user", "null conversation"), (None, 1, "user", "> null conversation\nyes"), (50, None, "user", "> a"), (51, 0, None, None), (51, 1, "user", "")]
    rows += [(60, 0, "user", LONG), (60, 1, "user", f"> {LONG}\nlong"), (61, 0, "a", "twice"), (61, 0, "a", "twice"), (61, 1, "b", "> twice"), (61, 1, "b", "> twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    for c in ("row", "at", "hash", "passage", "blocks", "lines", "own", "_row", "_tie", "root"):
        df = df.withColumn(c, F.lit("x"))
    got = chat.link_quotes(df).collect()
    key = lambda r: tuple((v is None, str(v)) for v in r)
    mine = sorted(((r["conv_id"], r["turn"], r["reply_to"], r["root_turn"], r["quote_levels"], r["n_quotes"], r["n_linked"], r["text"]) for r in got), key=key)
    assert mine == sorted(plain_links(rows), key=key)
    for conv in {r["conv_id"] for r in got}:  # thread by thread, replies behind what they answer
        placed = sorted((r for r in got if r["conv_id"] == conv), key=lambda r: r["position"])
        assert [r["position"] for r in placed] == list(range(len(placed)))
        order = [(r["root_turn"] is not None, r["root_turn"] or 0, r["turn"] is not None, r["turn"] or 0) for r in placed]
        assert order == sorted(order)
    again = {(r["conv_id"], r["position"]): r["text"] for r in chat.link_quotes(df.repartition(7)).collect()}
    assert again == {(r["conv_id"], r["position"]): r["text"] for r in got}  # ties do not depend on the scan
    assert chat.formatted(chat.link_quotes(df.filter("false"))).count() == 0


# ---- pipeline
def test_pipeline_against_plain_python(spark):
    sys.path.insert(0, "/root/repo") if "/root/repo" not in sys.path else None
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    stage = dict(P.STAGES)
    # documents that the rules reject go
    model = quality.fit_labels(docs, catalog.labels_for_fit(spark.read.parquet(f"{SMALL}/labels.parquet")))
    kept = stage["quality_filter"](spark, docs, SMALL).cache()
    good = {i for i, r in rows.items() if brute_score(model, r["text"]) >= 0.5}
    assert {r["doc_id"] for r in kept.collect()} == good and 0 < len(good) <= len(rows)
    # of equal texts the largest id stays
    distinct = stage["exact_dedup"](spark, kept, SMALL).cache()
    largest = {}
    for i in good:
        largest[rows[i]["text"]] = max(largest.get(rows[i]["text"], i), i)
    assert {r["doc_id"] for r in distinct.collect()} == set(largest.values())
    # of near copies the smallest id stays
    near = stage["simhash_near_dedup"](spark, distinct, SMALL).cache()
    left = sorted(largest.values())
    prints = {i: brute_fingerprint(rows[i]["text"]) for i in left}
    parent = {i: i for i in left}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in left:
        for b in left:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {r["doc_id"] for r in near.collect()} == {find(i) for i in left}
    # every document as often as the mix takes its words
    mixed = stage["mix_sources"](spark, near, SMALL).cache()
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mixed_sizes(near).collect()}
    copies = {i: math.floor(t / n + 0.5) if n else 1 for i, (t, n) in taken.items()}
    got = {}
    for r in mixed.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
        assert (r["text"], r["source"]) == (rows[r["doc_id"]]["text"], rows[r["doc_id"]]["source"])
    assert got == {i: c for i, c in copies.items() if c} and all(len(words(rows[i]["text"])) == n for i, (_, n) in taken.items())
    # every copy's ids are packed once
    import public_tokenizers
    from rxlake.llm import packing
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    packed, fill = {}, {}
    for r in stage["pack_sequences"](spark, mixed, SMALL).collect():
        packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["length"]
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert packed == {i: c * (len(tok.encode(rows[i]["text"], add_special_tokens=False).ids) + 1) for i, c in got.items()}
    for pieces in fill.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))] and sum(n for _, n in pieces) <= 2048


def test_pipeline_on_an_empty_table(spark, tmp_dir):
    import corpus_pipeline as P

    for t in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").filter("false").write.parquet(f"{tmp_dir}/{t}.parquet")
    assert P.run(spark, tmp_dir).count() == 0


def test_stages_take_null_and_repeated_rows(spark, tmp_dir):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900_001, None, "en", None, 0), (900_002, "", None, "s", 0), (5, LONG, "en", "s", 9), (5, LONG, "en", "s", 9)], docs.schema)
    docs.limit(60).union(odd).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{tmp_dir}/labels.parquet")
    kept = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for name, fn in P.STAGES[:-1]:
        kept = fn(spark, kept, tmp_dir)
        assert kept.columns == docs.columns, name
    assert P.run(spark, tmp_dir).count() > 0


def test_digests_of_equal_texts(make_docs):
    got = exact.exact_groups(make_docs(EDGES)).collect()
    assert {r["text_sha256"] for r in got} == {hashlib.sha256((t or "").encode()).hexdigest() for _, t in EDGES}
    assert simhash.simhash_components(make_docs(EDGES)).count() == len(EDGES)
