"""Mixer weights from all training texts; lookups of one direction."""

from itertools import combinations

import numpy as np
import pyarrow as pa

from handover.llm import graph, lm, simhash


def test_start_weights_are_fitted_on_all_texts(spark):
    from handover.llm.queries import ship

    ship(spark)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{min(int(x), 39)}" for x in rng.geometric(0.1, 30)) for _ in range(900)]
    words = [(lm.END, 900), *((b"w%d" % i, 900 // (i + 1) + 2) for i in range(40))]
    coder = lm.Coder(words, 5, bits=12)
    models = [lm.Model(coder, rng.integers(-40, 41, (3, 1 << 12)).astype(np.int8)) for _ in range(2)]
    rows = [(t, i % 2 == 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "text string, half boolean").repartition(3)
    types = spark.createDataFrame([(b"abc%d" % i, i % 2 == 1) for i in range(200)], "token binary, half boolean")
    got = lm._fit_weights(docs, types, spark.sparkContext.broadcast(models), "text")

    # plain Newton steps over the decisions of every text and word
    want, found = lm.Model(coder, models[0].tables), []
    for half in (False, True):
        other = models[not half]
        place = [(p, w) for t, h in rows if h == half for p, w in enumerate([*t.encode().split(), lm.END])]
        symbol = coder.symbols(pa.array([w for _, w in place], pa.large_binary()))
        found.append((other, coder.word_events(symbol, np.array([p for p, _ in place])), 0))
        spelled = pa.array([b"abc%d" % i for i in range(200) if (i % 2 == 1) == half], pa.large_binary())
        found.append((other, coder.byte_events(*lm.binary_parts(spelled)), 1))
    for _ in range(12):
        sums = []
        for other, events, kind in found:
            m = lm.Model(coder, other.tables)
            m.weights = want.weights
            sums.append(m.slopes(*m.by_gate(events, kind)))
        want.weights = lm.Model(coder, models[0].tables).solved(*(sum(x) for x in zip(*sums)))
    assert np.abs(got - models[0].weights).max() > 0.1  # they moved
    np.testing.assert_allclose(got, want.weights, atol=0.05)


def test_one_lookup_for_each_pair_of_neighbours(spark):
    rng = np.random.default_rng(9)
    base = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    fps = sorted({b ^ sum(1 << int(i) for i in rng.choice(63, int(k), replace=False)) for b in base for k in rng.integers(0, 6, 6)})
    table = spark.createDataFrame([(f, 1) for f in fps], "fp long, n long")
    m = simhash.segments_for(4)
    looked = simhash._entries(table, m, 1).count()
    whole = sum(simhash.BITS // m + (i < simhash.BITS % m) + 1 for i in range(m)) * len(fps)
    assert looked < 0.6 * whole  # before: all of them
    got = {r["node"]: r["root"] for r in graph.components(simhash.links(table, 4)).collect()}
    up = {f: f for f in fps}

    def top(f):
        while up[f] != f:
            f = up[f]
        return f

    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 4:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    assert {f: got.get(f, f) for f in fps} == {f: top(f) for f in fps}


def test_words_of_several_parts_are_looked_up_at_once(monkeypatch):
    monkeypatch.setattr(lm, "_EVENTS", 40)
    texts = ["One two  THREE\tone", None, "", "Ärger ä Z" * 20, " \x0b\x0c ", *(f"w{i} W{i} x\x00y" for i in range(60))]
    coder = lm.Coder([(lm.END, 5), (b"one", 4), (b"w7", 3)], 2, bits=8)
    calls, symbols = [], coder.symbols
    coder.symbols = lambda distinct: calls.append(len(distinct)) or symbols(distinct)
    batches = [pa.record_batch([pa.array(texts[a:b], pa.string())], names=["text"]) for a, b in ((0, 9), (9, 9), (9, 65))]
    got, at, parts = [], 0, 0
    for part, code, distinct, known, row in lm._parts(iter(batches), "text", coder):
        got += [(at + r, distinct[c].as_py(), k) for r, c, k in zip(row.tolist(), code.tolist(), known[code].tolist())]
        at, parts = at + part.num_rows, parts + 1
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    own = {b"one": 1, b"w7": 2}
    assert got == [(i, w, own.get(w, 3)) for i, t in enumerate(texts) for w in (t or "").encode().translate(lower).split()]
    assert at == len(texts) and parts > 15 and len(calls) == 1  # before: a lookup in the whole tree for each part
    monkeypatch.setattr(lm, "_LOOKUP", 10)
    assert len(list(lm._parts(iter(batches), "text", coder))) == parts and len(calls) > 10


def test_counts_are_sent_in_as_few_bytes_as_they_need():
    counter = lm._Counter(13)
    want = np.zeros_like(counter.table)
    for k, slot, n in ((0, 5, 255), (1, 9, 256), (1, 9, 65_279), (2, 8_000, 65_536)):
        counter.add((None, None, np.ones(n, np.int8), *(np.full(n, slot if j == k else 8_191 - j, np.uint32) for j in range(3))))
        for j in range(3):
            want[j, 2 * (slot if j == k else 8_191 - j) + 1] += n
    got, widths = np.zeros((counter.table.size // (2 * lm._SLOTS), 2 * lm._SLOTS), np.int64), set()
    for batch in lm._table_rows(counter):
        for r in batch.to_pylist():
            widths.add(r["width"])
            got[r["block"]] += np.frombuffer(pa.decompress(r["payload"], 2 * r["width"] * lm._SLOTS, "zstd", asbytes=True), f"<u{r['width']}")
    assert (got.ravel() == want.ravel()).all() and widths == {1, 2, 4}  # before: four bytes always
