"""The training-data operators against brute force, on small tables with nulls, empty and long texts, ties and repeats."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from handover.llm import bpe, decontam, graph, langid, lengths, linededup, lm, pii, quality, queries, simhash, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_AZ = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, kept int, fingerprint string, n_words string"


def texts():
    rng = random.Random(5)
    base = ["alpha beta gamma delta epsilon", "one two three", "x", "Ünï cödé 日本 12,5 don't"]
    words = [f"w{i}" for i in range(60)]
    out = [None, "", "   \n\t ", *base, base[0], base[0]]
    line = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(3, 9)))
    passage = [line() for _ in range(5)]
    for i in range(12):
        out.append("\n".join([line() for _ in range(3)] + (passage if i % 3 else []) + ["", line()]))
    out.append(out[-1])
    out.append(out[-1].replace("w1 ", "w2 ", 1))
    out.append(" ".join(rng.choice(words) for _ in range(30_000)))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    queries.ship(spark)
    rows = [(i if i != 9 else 8, t, ["en", "fr", None][i % 3], "s", None, "clash", 7, "clash", "clash") for i, t in enumerate(texts())]
    rows += [(None, "null key one", None, None, 1, None, None, None, None), (None, "null key one", None, None, 1, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def words(text):
    return WORD.findall(text or "")


# --- op7 BPE


def test_bpe_equals_the_library():
    rng = random.Random(2)
    parts = ["a", "th", "'", "'s", " ", "  ", "\n", "é", "1", "!", "ll", "日", "\t", " ", "<|endoftext|>", "S", "ing", "\u0085"]
    given = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(2000)] + [None, "", " " * 300, "a" * 700]
    codec = bpe.codec(PATH)
    ids, off = codec.encode(pa.array(given, pa.string()))
    tok = Tokenizer.from_file(PATH)
    want = [e.ids for e in tok.encode_batch([t or "" for t in given], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == want
    assert codec.decode(ids, off).to_pylist() == [tok.decode(x, skip_special_tokens=False) for x in want]


def test_bpe_decode_replaces_broken_bytes():
    tok = Tokenizer.from_file(PATH)
    part = tok.encode("日", add_special_tokens=False).ids[:1]
    got = bpe.codec(PATH).decode(np.array(part + part, np.int64), np.array([0, 1, 2]))
    assert got.to_pylist() == [tok.decode(part, skip_special_tokens=False)] * 2


def test_bpe_query_and_edges(spark, docs):
    done = bpe.encode_decode(docs, PATH, decoded="back").collect()
    assert len(done) == docs.count()
    assert all(r["back"] == (r["text"] or "") for r in done)
    assert bpe.encode_decode(docs.limit(0), PATH).count() == 0
    again = bpe.decode(spark.createDataFrame([(1, None), (2, [64, 65])], "k int, ids array<int>"), PATH).orderBy("k").collect()
    assert [r["decoded"] for r in again] == ["", Tokenizer.from_file(PATH).decode([64, 65])]
    tok = Tokenizer.from_file(PATH)
    for r in queries.op7_bpe_encoding(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect():
        ids = tok.encode(r["text"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


# --- op10 SimHash


def brute_simhash(given):
    def fp(text):
        w = [x.translate(_AZ) for x in words(text)]
        grams = [" ".join(w[i : i + 4]) for i in range(max(len(w) - 3, min(len(w), 1)))]
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(t) for _, t in given]
    low = [k for k, _ in given]
    least = lambda a, b: a if b is None else b if a is None else min(a, b)
    comp = list(range(len(given)))
    for _ in given:
        for i in range(len(given)):
            for j in range(len(given)):
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    comp[i] = comp[j] = min(comp[i], comp[j])
        if all(comp[c] == c for c in comp):
            break
    best = {}
    for i, c in enumerate(comp):
        best[c] = least(best.get(c), low[i])
    return Counter((k, f"{f:016x}", best[c]) for (k, _), f, c in zip(given, fps, comp))


def test_simhash_components(docs):
    given = [(k, t) for k, t in rows_of(docs) if len(t or "") < 10_000]
    got = simhash.components(docs.where("text is null or length(text) < 10000"))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()) == brute_simhash(given)
    kept = simhash.deduplicate(docs.where("text is null or length(text) < 10000"))
    assert kept.columns == docs.columns
    assert kept.count() == got.select("component_id").distinct().count()
    assert simhash.components(docs.limit(0)).count() == 0


def same_components(spark, given, distance, m=None):
    """Whether ``links`` connects what all pairs within the distance connect."""
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in given)
    found = graph.components(simhash.links(spark.createDataFrame([(f, 1) for f in signed], "fp long, n long").repartition(4), distance, m))
    root = {r["node"]: r["root"] for r in found.collect()}
    comp = {f: f for f in signed}

    def top(f):
        while comp[f] != f:
            f = comp[f]
        return f

    fps = np.array(signed, np.int64).view(np.uint64)
    for i, a in enumerate(signed):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= distance).tolist():
            x, y = top(a), top(signed[j])
            comp[max(x, y)] = min(x, y)
    assert {f: root.get(f, f) for f in signed} == {f: top(f) for f in signed}
    return len({top(f) for f in signed})


def scattered():
    rng = random.Random(3)
    given = {rng.getrandbits(64) for _ in range(300)}
    for f in list(given)[:60]:
        for _ in range(6):
            given.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    return given


@pytest.mark.parametrize("distance, m", [(4, None), (4, 2), (4, 5), (3, None), (2, None), (1, None), (0, None)])
def test_links_between_close_fingerprints(spark, distance, m):
    same_components(spark, scattered(), distance, m)


def dense(n, low, high, first=0):
    """Near copies: neighbours differ in some bits (of those from ``first`` on), and few of them are linked."""
    rng = random.Random(8)
    centre, out = rng.getrandbits(64), set()
    while len(out) < n:
        out.add(centre ^ sum(1 << b for b in rng.sample(range(first, 64), rng.randint(low, high))))
    return out | {rng.getrandbits(64) for _ in range(50)}


@pytest.mark.parametrize("distance, low, high", [(4, 5, 8), (4, 1, 5), (4, 7, 12), (3, 5, 8), (2, 3, 5)])
def test_links_in_a_dense_group(spark, distance, low, high):
    n = same_components(spark, dense(600, low, high), distance)
    assert n > 50
    same_components(spark, dense(300, low, high, 32), distance)


@pytest.mark.parametrize("bucket", [1, 3])
def test_links_with_every_level_crowded(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    same_components(spark, dense(200, 4, 7) | scattered(), 4)
    same_components(spark, dense(150, 4, 7), 3)


def test_no_join_lists_the_pairs_of_a_dense_group(spark, monkeypatch):
    """What is written grows with the group, not with its square."""
    rows = {}
    write = simhash.scratch.write

    def counted(df, name):
        out = write(df, name)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(simhash.scratch, "write", counted)
    given = dense(1500, 6, 9, 36)
    signed = [f - (1 << 64) if f >> 63 else f for f in given]
    simhash.links(spark.createDataFrame([(f, 1) for f in signed], "fp long, n long"), 4)
    assert rows["dense"] > 500  # the deepest level is reached
    assert max(rows.values()) < 67 * 5 * len(given)


def test_columns_named_like_helpers_stay(spark):
    names = ["__row", "__fp", "__keep", "fp", "n", "low", "row", "__gone", "__l", "__key", "__all", "in_text"]
    df = spark.createDataFrame([(1, "a b c d e", *names), (2, "a b c d e", *names)], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = simhash.components(df)
    assert out.columns == [*df.columns, "fingerprint", "component_id", "representative"]
    assert all(list(r)[2 : 2 + len(names)] == names for r in out.collect())
    one = simhash.deduplicate(df).collect()
    assert len(one) == 1 and list(one[0])[2:] == names


# --- op9 line dedup


def brute_lines(given):
    """Later occurrences by (key, nulls last, order of equal keys free)."""
    seen, out = set(), []
    for k, t in sorted(given, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = (t or "").split("\n") if t is not None else []
        at = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for i in range(len(at) - 2):
            w = tuple(lines[j].strip(" \t\n\x0b\x0c\r") for j in at[i : i + 3])
            if w in seen:
                gone.update(at[i : i + 3])
            seen.add(w)
        out.append((k, len(lines), len(gone), t if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return Counter(out)


def test_line_dedup(docs):
    got = linededup.remove_repeated_lines(docs)
    assert Counter((r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in got.collect()) == brute_lines(rows_of(docs))
    assert got.where("n_removed > 0").count() > 3
    assert linededup.remove_repeated_lines(docs.limit(0)).count() == 0


# --- op4 decontamination


def brute_leaks(given, items):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for k, t in given:
        w = split(t)
        for item, text in items:
            v = split(text)
            if not v:
                continue
            n, g = len(v), min(len(v), 5)
            grams = lambda x: Counter(tuple(x[i : i + g]) for i in range(len(x) - g + 1))
            want, best = grams(v), 0.0
            for i in range(len(w)):
                have = grams(w[i : i + n])
                union = sum((want | have).values())
                best = max(best, sum((want & have).values()) / union)
            if best >= 0.8:
                out[k, item] = max(out.get((k, item), 0), best)
    return out


def test_decontamination(spark):
    queries.ship(spark)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([12, 30, 30, 3, 1, 60])]
    items += [(6, None), (7, "!!"), (8, items[1][1]), (None, items[0][1])]
    given = []
    for i in range(40):
        v = items[i % 6][1].split()
        if i % 4 == 1:
            v[rng.randrange(len(v))] = "changed"
        if i % 4 == 2:
            v.insert(len(v) // 2, "added")
        if i % 4 == 3:
            v = v[: len(v) * 3 // 4]
        given.append((i, " ".join([word() for _ in range(20)] + ["(" + v[0].upper(), *v[1:]] + [word() for _ in range(i % 3 * 10)]) + "."))
    given += [(50, None), (51, ""), (52, given[0][1]), (52, given[0][1]), (None, given[0][1])]
    docs = spark.createDataFrame([(k, t, "clash") for k, t in given], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, h int")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontam.find_leaks(docs, bench).collect()}
    want = brute_leaks(given, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    clean = decontam.remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(k for k, t in given if not any(a == k for a, _ in want))
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontam.find_leaks(docs.limit(0), bench).count() == 0


def test_decontamination_of_repeated_shingles(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([104, 204, 204, 9])]
    items.append((4, " ".join([word() for _ in range(20)] + ["la"] * 30 + [word() for _ in range(20)])))
    given = []
    for i in range(20):
        v = items[i % 5][1].split()
        kept = v[: {104: 93, 204: 182, 9: 8, 70: 64}[len(v)]]
        given.append((i, " ".join([word() for _ in range(5)] + kept + ([] if len(v) == 9 else ["no"] * (len(v) - len(kept) + i)))))
    docs = spark.createDataFrame(given, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontam.find_leaks(docs, bench).collect()}
    want = brute_leaks(given, items)
    assert len(want) == 20 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_decontamination_radius():
    # 4 of 5 shingles: a bit differs if the four tie and the fifth decides, 6/16 x 1/2
    assert math.isclose(decontam._differ(4, 1, 0), 3 / 16)
    allowed = decontam.radii(0.8)
    assert allowed[:4] == [0] * 4 and sum(math.comb(64, i) * (3 / 16) ** i * (13 / 16) ** (64 - i) for i in range(allowed[4] + 1, 65)) <= 1e-9


# --- op3 quality


def brute_measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover), len(lines), len(re.findall("[A-Z]", text)), text.count("!")


def test_quality_measures(spark, docs):
    more = docs.limit(0).unionByName(docs).select("doc_id", "text").union(spark.createDataFrame([(900, "a b c d e f g h i " * 3 + "\n# x |\n# x |"), (901, "A!")], "doc_id long, text string"))
    for r in quality.measure(more).collect():
        assert tuple(r[m] for m in quality.MEASURES) == brute_measures(r["text"])


def test_binomial_bound():
    assert math.isclose(quality.binomial_at_most(2, 10, 0.3), sum(math.comb(10, i) * 0.3**i * 0.7 ** (10 - i) for i in range(3)))


def test_quality_cutoffs_keep_their_guarantee(spark, docs):
    rng = random.Random(1)
    rows = [(i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(40)) + (" |" * 10 if i % 10 == 0 else "")) for i in range(4000)]
    given = spark.createDataFrame([(i, t, ["en", None][i // 10 % 2]) for i, t in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 10 != 0)) for i, _ in rows] + [(0, 0), (None, 1), (5, None)], "doc_id long, quality int")
    measured = quality.measure(given)
    cut = quality.choose_cutoffs(measured, labels)
    chosen = cut.collect()
    assert {r["stratum"] for r in chosen} == {"en", None}
    tests = 2 * sum(len(g) for _, g in quality.RULES.values())
    for r in chosen:
        assert quality.binomial_at_most(r["false_rejected"], r["n_good"], 0.05 / len(quality.RULES)) <= 0.05 / tests
    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(measured, cut).collect()}
    assert not any(verdict[i] for i in range(0, 4000, 10))
    assert sum(verdict[i] for i in range(4000) if i % 10) > 3500
    kept = quality.filter_documents(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(k for k, t in rows_of(docs) if (m := brute_measures(t))[0] >= 20 and 100 * m[4] <= 30 * m[0] and k is not None or k is None and len(words(t)) >= 20)
    assert quality.filter_documents(docs.limit(0), labels.limit(0)).count() == 0


def test_quality_cutoffs_of_a_fixed_sequence(spark):
    rows = [(i, " ".join(f"word{j}" for j in range(i, i + 30)) + (" |" * 10 if i >= 900 else ""), "en") for i in range(1000)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 900)) for i, _, _ in rows], "doc_id long, quality int")
    part = 0.05 / len(quality.RULES)
    # 900 good labels without a false rejection suffice if the walk along a grid takes one test's error
    assert 0.05 / sum(len(g) for _, g in quality.RULES.values()) < quality.binomial_at_most(0, 900, part) <= part
    assert "symbols" in {r["rule"] for r in quality.choose_cutoffs(quality.measure(given), labels).collect()}


# --- op5 lengths


def test_length_sums(docs):
    tok = Tokenizer.from_file(PATH)
    n = [len(tok.encode(t or "", add_special_tokens=False).ids) for _, t in rows_of(docs)]
    sums = lengths.suffix_sums(lengths.histogram(docs, PATH))
    for r in sums.collect():
        at = r["length"]
        assert r["n_docs"] == n.count(at) and r["docs_at_least"] == sum(x >= at for x in n) and r["docs_at_most"] == sum(x <= at for x in n)
        assert r["tokens_at_least"] == sum(x for x in n if x >= at) and r["truncated_tokens"] == sum(min(x, at) for x in n)
    limits = [0, 1, 7, 100, 10**6]
    assert lengths.truncated_totals(sums, limits) == {x: (sum(min(y, x) for y in n), sum(y > x for y in n)) for x in limits}
    order = sorted(n)
    assert lengths.quantiles(sums, [0.1, 0.5, 1.0]) == {q: order[math.ceil(q * len(n)) - 1] for q in (0.1, 0.5, 1.0)}
    empty = lengths.suffix_sums(lengths.histogram(docs.limit(0), PATH))
    assert empty.count() == 0 and lengths.quantiles(empty, [0.5]) == {0.5: None} and lengths.truncated_totals(empty, [5]) == {5: (0, 0)}


# --- op1 language model


def test_lm_base_and_scores(docs):
    given = rows_of(docs)
    out = lm.score_documents(docs).collect()
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 10 == 0
    tokens = lambda t: [w.translate(_AZ) for w in words(t)] + [" "]
    count = Counter(x for k, t in given if not held(k) for x in tokens(t))
    n, v = sum(count.values()), len(count)
    base = lambda t: sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t))
    want = sorted((k is None, k or 0, held(k), len(tokens(t)), sum(count[x] > 0 for x in tokens(t)), n, round(base(t), 6)) for k, t in given)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out) == want
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in out)
    assert lm.score_documents(docs.limit(0)).count() == 0
    alone = lm.score_documents(docs.where("doc_id is not null and crc32(cast(doc_id as string)) % 10 = 0")).collect()
    assert all(r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in alone)


def test_lm_paths_are_a_code():
    nodes, bits, off, _ = lm._huffman([5, 1, 1, 9, 2])
    paths = ["".join(map(str, bits[a:b])) for a, b in zip(off, off[1:])]
    assert len(set(paths)) == 5 and math.isclose(sum(2.0 ** -len(p) for p in paths), 1)


def test_lm_beats_the_base(spark):
    out = queries.op1_lm_scores(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


# --- op2, op6


def test_language_identification(spark, docs):
    sf = "/root/testdata/sf0.01"
    out = queries.op2_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    edge = langid.identify(docs).collect()
    assert len(edge) == docs.count()
    assert all((r["lang_pred"] == "und") == (r["score"] == 0) for r in edge)
    by = {r["doc_id"]: r["lang_pred"] for r in edge}
    assert by[0] == by[1] == by[2] == "und" and by[3] in ("en", "fr")
    assert langid.identify(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_toxicity(spark, docs):
    sf = "/root/testdata/sf0.01"
    out = queries.op6_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    pairs = [(a["score"], b["score"]) for a in out if a["toxic"] for b in out if not b["toxic"]]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs) > 0.75
    assert not any(r["predicted"] for r in out if not r["toxic"])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    edge = toxicity.score_documents(docs, none).collect()
    assert len(edge) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in edge)
    odd = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (4, None), (4, 0)], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, odd).count() == docs.count()
    assert toxicity.score_documents(docs.limit(0), odd).count() == 0


def test_samples_are_bounded_in_rows(spark, monkeypatch):
    queries.ship(spark)
    rows = [(7, f"copy {i} of one key", "en") for i in range(300)] + [(None, f"null key {i}", "en") for i in range(300)]
    rows += [(8, "an equal row", "fr")] * 300 + [(1000 + i, f"bon jour {i}", "fr") for i in range(50)] + [(2000 + i, f"good day {i}", "en") for i in range(600)]
    given = spark.createDataFrame(rows, "key long, text string, lang string").repartition(4)
    monkeypatch.setattr(langid, "PER_LANGUAGE", 100)
    languages, train, rest = langid._sample(given)
    n = Counter(languages[d[2]] for d in train + rest)
    assert n == {"en": 100, "fr": 51}
    collected = []
    fit = toxicity.label_model
    monkeypatch.setattr(toxicity, "label_model", lambda votes, *a: collected.append(len(votes)) or fit(votes, *a))
    labels = spark.createDataFrame([(7, 1), (8, 0), *((2000 + i, i % 2) for i in range(40))], "doc_id long, toxic int")
    out = toxicity.score_documents(given.withColumnRenamed("key", "doc_id"), labels)
    assert out.count() == len(rows)
    assert collected == [sum(zlib.crc32(str(k).encode()) % 4 != 2 for k in [7, 8, *range(2000, 2040)])]


# --- op8 PII


KEY = b"k"


def test_feistel_is_a_permutation():
    for size in (1, 2, 7, 26, 1000):
        turned = [pii.permute(v, size, KEY, "t") for v in range(size)]
        assert sorted(turned) == list(range(size))
        assert [pii.permute(v, size, KEY, "t", back=True) for v in turned] == list(range(size))


@pytest.mark.parametrize("value", ["4111 1111 1111 1111", "5500005555555559", "219-09-9999", "(415) 555-2671", "+1 (988) 555-2485", "+44 20 7946 0958", "192.168.7.31", "2024-02-29", "31.12.1999", "john.doe7@mail.example.com", "DE89 3704 0044 0532 0130 00"])
def test_pseudonyms_round_trip(value):
    text = f"Call {value}, or {value}. End"
    new, spans = pii.pseudonymise(text, KEY)
    assert len(spans) == 2 and value not in new and spans[0][3] == spans[1][3]
    assert re.sub(r"[a-z]", "a", re.sub(r"\d", "0", spans[0][3])).count("0") == re.sub(r"\d", "0", value).count("0") or spans[0][0] == "ip"
    assert pii.pseudonymise(new, KEY, back=True)[0] == text
    assert pii.pseudonymise(text, b"other")[0] != new


def test_pseudonyms_of_either_reading():
    days = [(d, m, y) for y in (1931, 1999) for m in range(1, 13) for d in range(1, 29)]
    areas = [f"{a:03d}" for a in range(0, 1000, 7)]
    kinds = [
        {f"{a:02d}{mark}{b:02d}{mark}{y}" for d, m, y in days for a, b in ((d, m), (m, d))} for mark in "/-."
    ] + [{f"+1 ({a}) {e}-{n}" for a in areas for e in ("017", "155", "555") for n in ("7713", "0000")}]
    for values in kinds:
        made = {v: pii.pseudonymise(v, KEY)[0] for v in values}
        assert len(set(made.values())) == len(values)
        assert all(pii.pseudonymise(new, KEY, back=True)[0] == v for v, new in made.items())


def test_iban_pseudonyms_keep_other_check_digits():
    number = lambda t: int("".join(str(int(c, 36)) for c in t))
    seen = set()
    for i in range(600):
        body = f"{i:018d}"
        for c in range(100):
            value = f"DE{c:02d}{body}"
            if number(body + value[:4]) % 97 == 1:
                new = pii.pseudonymise(value, KEY)[0]
                assert number(new[4:] + new[:4]) % 97 == 1 and new not in seen and pii.pseudonymise(new, KEY, back=True)[0] == value
                seen.add(new)


@pytest.mark.parametrize("value", ["4111 1111 1111 1112", "000-12-3456", "999.1.1.1", "2023-02-30", "12345", "1.2.3.4.5", "@nobody"])
def test_invalid_values_stay(value):
    assert pii.pseudonymise(f"x {value} y", KEY) == (f"x {value} y", [])


def test_pii_documents(spark, docs):
    done = pii.pseudonymise_documents(docs, KEY)
    assert done.count() == docs.count() and done.where("text is null").count() == docs.where("text is null").count()
    back = pii.pseudonymise_documents(done, KEY, restore=True)
    assert Counter(rows_of(back)) == Counter(rows_of(docs))
    assert pii.pseudonymise_documents(docs.limit(0), KEY).count() == 0


# --- pipeline


def test_pipeline(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    given = docs.collect()
    good = [r for r in given if (m := brute_measures(r["text"]))[0] >= 20 and 100 * m[4] <= 30 * m[0]]
    stage = dict(cp.STAGES)
    first = cp.scratch.write(stage["quality rules"](spark, docs, sf), "t")
    assert {r["doc_id"] for r in first.collect()} == {r["doc_id"] for r in good}  # too few labels for any cutoff
    second = cp.scratch.write(stage["line dedup"](spark, first, sf), "t")
    want = brute_lines([(r["doc_id"], r["text"]) for r in good])
    assert Counter((r["doc_id"], r["text"]) for r in second.collect()) == Counter((k, t) for k, _, _, t in want)
    third = cp.scratch.write(stage["SimHash near-dedup"](spark, second, sf), "t")
    assert {r["doc_id"] for r in third.collect()} == {c for _, _, c in brute_simhash([(r["doc_id"], r["text"]) for r in second.collect()])}
    fourth = cp.scratch.write(stage["benchmark decontamination"](spark, third, sf), "t")
    leaks = decontam.find_leaks(third, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
    assert {r["doc_id"] for r in fourth.collect()} == {r["doc_id"] for r in third.collect()} - {r["doc_id"] for r in leaks}
    last = cp.run(spark, sf)
    tok = Tokenizer.from_file(PATH)
    text = {r["doc_id"]: r["text"] for r in fourth.collect()}
    assert {r["doc_id"]: r["ids"] for r in last.collect()} == {k: tok.encode(t, add_special_tokens=False).ids for k, t in text.items()}
    assert all(f.columns == docs.columns for f in (first, second, third, fourth))
    assert stage["SimHash near-dedup"](spark, stage["line dedup"](spark, docs.limit(0), sf), sf).count() == 0
