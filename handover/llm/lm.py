"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is its lower-cased (A-Z) words and one end; white space isn't scored. A
word is coded by binary decisions: the path to it in a Huffman tree over the
most frequent words. A word outside the tree takes the path of an escape; then
it is either known (its share among the corpus's rarer words) or novel (spelled
byte by byte along a second tree).

Each decision is predicted four times: from the node alone (exact counts), and
from three hashed contexts (words: the last, the one before, both; bytes: the
last one, two and three of the word), whose zeros and ones were counted over all
training texts. The logits are mixed with weights picked by a gate - which
contexts have been seen, and the kind of decision. The mixer starts from weights
fitted on all training texts, each half of them on the counts of the other half,
and each text then refines its own weights by the gradient after every block of
words.

What is gathered: a count for every distinct word of the corpus (a table, joined
by word), and the context counts, summed by block in slots whose number follows
the training tokens up to what a worker's memory holds (``MOST_BITS``).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handover.llm import scratch
from handover.llm.batches import binary_parts, chunks, codes, ragged, text_bytes, words

END = b" "  # no word holds a space
TREE_WORDS = 65_536
TREE_WORD_BYTES = 64
LEAST_BITS, MOST_BITS = 20, 21  # of a context table: eight slots and more for each training token, as far as a worker's memory goes
FIRST_STEPS = 3  # Newton steps of a task on its first decisions of a kind, before it goes on to others
_CONTEXTS, _GATES = 3, 16
_SLOTS = 4096  # of a block that is summed as one row
_BLOCK = 64  # words between two refinements of a text's weights
_RATE = 0.002
_EVENTS = 1 << 19  # bytes of text whose decisions are held at once
_LOOKUP = 16 << 20  # bytes of rows and codes, from so many on their words are looked up in the tree
_LANE = 1 << 14  # decisions whose slopes are summed while they are in the processor's cache
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _huffman(weights: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Path of each symbol: nodes and bits end to end, offsets; and each node's logit of bit 1."""
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    total = list(weights) + [0] * (n - 1)
    up, bit = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int8)
    logit = np.zeros(max(n - 1, 1), np.float32)
    node = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total[node] = total[a] + total[b]
        up[a] = up[b] = node
        bit[b] = 1
        logit[node - n] = np.log(total[b] / total[a])
        heapq.heappush(heap, (total[node], node))
        node += 1
    depth = np.zeros(2 * n - 1, np.int64)
    for i in range(2 * n - 3, -1, -1):
        depth[i] = depth[up[i]] + 1
    off = np.zeros(n + 1, np.int64)
    np.cumsum(depth[:n], out=off[1:])
    nodes, bits = np.zeros(off[-1], np.int64), np.zeros(off[-1], np.int8)
    at, place = np.arange(n), off[1:] - 1
    live = np.flatnonzero(depth[:n] > 0)
    while len(live):
        nodes[place[live]], bits[place[live]] = up[at[live]] - n, bit[at[live]]
        at[live] = up[at[live]]
        place[live] -= 1
        live = live[depth[at[live]] > 0]
    return nodes, bits, off, logit


def _mixed(x: np.ndarray) -> np.ndarray:
    """32 well-mixed bits of each 64-bit value."""
    x = (x ^ x >> np.uint64(31)) * _MIX
    return ((x ^ x >> np.uint64(29)) * _MIX2 >> np.uint64(32)).astype(np.uint32)


class Coder:
    """The two trees: words to decisions."""

    def __init__(self, tree_words: list[tuple[bytes, int]], escapes: int, bits: int = LEAST_BITS):
        self.table_bits = bits
        self.vocabulary = pa.array([w for w, _ in tree_words], pa.large_binary())
        self.counts = np.array([c for _, c in tree_words], np.float64)
        self.escape = len(tree_words)
        self.nodes, self.bits, self.off, logit = _huffman([*(c for _, c in tree_words), max(escapes, 1)])
        data, off = binary_parts(self.vocabulary)
        bytes_ = np.bincount(data, minlength=257) + 1
        bytes_[256] = len(off)
        nodes, self.byte_bits, self.byte_off, byte_logit = _huffman(bytes_.tolist())
        self.byte_nodes = nodes + len(logit)
        self.logit = np.concatenate([logit, byte_logit])
        salt = _mixed(np.arange(len(self.logit), dtype=np.uint64) * _MIX)
        self.salt, self.byte_salt = salt[self.nodes], salt[self.byte_nodes]  # along the paths

    def symbols(self, distinct: pa.LargeBinaryArray | pa.ChunkedArray) -> np.ndarray:
        """Tree symbol of each word; the escape for words outside the tree."""
        found = pc.fill_null(pc.index_in(distinct, value_set=self.vocabulary), self.escape)
        return (found.to_numpy() if isinstance(found, pa.ChunkedArray) else found.to_numpy(zero_copy_only=False)).astype(np.int64)

    def word_events(self, symbol: np.ndarray, first: np.ndarray, order: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Decisions of a run of words (``first``: place in its text): word index, node, bit, and three context slots.

        ``order`` lists the words anew, each keeping its contexts; the word index then counts in that order.
        """
        start = np.uint64(self.escape + 1)
        s = symbol.astype(np.uint64)
        a = np.where(first > 0, np.concatenate([s[:1], s[:-1]]), start)
        b = np.where(first > 1, np.concatenate([s[:2], s[:-2]])[: len(s)], start)
        contexts = (a * _MIX2, (a << np.uint64(20) ^ b) * _MIX2 ^ np.uint64(1), b * _MIX2 ^ np.uint64(2))
        if order is not None:
            symbol, contexts = symbol[order], tuple(c[order] for c in contexts)
        return self._expand(self.nodes, self.bits, self.salt, self.off, symbol, contexts)

    def byte_events(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
        """Decisions that spell words, each with its end: word index, node, bit, and three context slots."""
        n, length = len(off) - 1, np.diff(off)
        at = ragged(off[:-1] + np.arange(n), length)
        spelled = np.full(len(data) + n, 256, np.int64)
        spelled[at] = data
        word = np.repeat(np.arange(n), length + 1)
        place = ragged(np.zeros(n, np.int64), length + 1)
        s = spelled.astype(np.uint64)
        last = [np.where(place >= k, np.concatenate([s[:k], s[:-k]])[: len(s)], np.uint64(257)) for k in (1, 2, 3)]
        one = last[0]
        two = one << np.uint64(9) ^ last[1]
        three = two << np.uint64(9) ^ last[2]
        contexts = (one * _MIX2 ^ np.uint64(3), two * _MIX2 ^ np.uint64(4), three * _MIX2 ^ np.uint64(5))
        i, *rest = self._expand(self.byte_nodes, self.byte_bits, self.byte_salt, self.byte_off, spelled, contexts)
        return word[i], *rest

    def _expand(self, nodes, bits, salts, off, symbol, contexts):
        length = off[symbol + 1] - off[symbol]
        at = ragged(off[symbol], length)
        salt = salts.take(at)
        # both are well mixed, so the upper bits of their sum are a hash of the two
        slots = [np.repeat(_mixed(c), length) for c in contexts]
        for slot in slots:
            slot += salt
            slot >>= np.uint32(32 - self.table_bits)
        return np.repeat(np.arange(len(symbol)), length), nodes.take(at), bits.take(at), *slots


def _tokens(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, pa.LargeBinaryArray, np.ndarray, int]:
    """Code of each word, the distinct words, and the row of each word."""
    data, off = text_bytes(part.column(text))
    _, length, row = words(data, off)
    data = data[(data != 32) & (data - np.uint8(9) > 4)]  # the words end to end
    data |= (data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5)  # A-Z lower-cased
    code, distinct = codes(data, np.cumsum(length) - length, length)
    return code, distinct, row, len(off) - 1


def _parts(batches: Iterator[pa.RecordBatch], text: str, coder: "Coder") -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.LargeBinaryArray, np.ndarray, np.ndarray]]:
    """Parts of ``_EVENTS`` bytes: the rows, each word's code, the distinct words and their symbols by code, each word's row.

    A lookup hashes the whole tree, so the distinct words of several parts are looked up together.
    """

    def found(held):
        symbol = coder.symbols(pa.chunked_array([h[2] for h in held], pa.large_binary()))
        end = np.cumsum([len(h[2]) for h in held])
        for (part, code, distinct, row), b in zip(held, end):
            yield part, code, distinct, symbol[b - len(distinct) : b], row

    held, n = [], 0
    for part in chunks(batches, text, _EVENTS):
        code, distinct, row, _ = _tokens(part, text)
        held.append((part, code, distinct, row))
        n += part.nbytes + code.nbytes + row.nbytes
        if n >= _LOOKUP:
            yield from found(held)
            held, n = [], 0
    if held:
        yield from found(held)


def _with_ends(symbol: np.ndarray, row: np.ndarray, rows: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols with each text's end put after its words; their rows and places."""
    count = np.bincount(row, minlength=rows) + 1
    out = np.full(len(symbol) + rows, end, np.int64)
    out[np.arange(len(symbol)) + row] = symbol
    return out, np.repeat(np.arange(rows), count), ragged(np.zeros(rows, np.int64), count)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, c): how often each word and the end (one for each row) occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text, 8 << 20):
            code, distinct, _, rows = _tokens(part, text)
            n = np.bincount(code, minlength=len(distinct))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([distinct.cast(pa.binary()), pa.array([END], pa.binary())]), pa.array(np.append(n, rows), pa.int64())], names=["token", "c"])

    return docs.select(F.col(f"`{text}`")).mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


class _Counter:
    """Zeros and ones of all slots."""

    def __init__(self, bits: int):
        self.table = np.zeros((_CONTEXTS, 2 << bits), np.int32)

    def add(self, events: tuple[np.ndarray, ...]) -> None:
        _, _, bit, *slots = events
        bit = bit.astype(np.uint32)
        for row, slot in zip(self.table, slots):
            at = slot << np.uint32(1)
            at |= bit
            at.sort()  # in order, the table is passed through once
            np.add.at(row, at, np.int32(1))


def _table_rows(counter: _Counter) -> Iterator[pa.RecordBatch]:
    """A task's counts as rows (block, width, payload), without blocks of zeros; width: bytes of a count."""
    parts = counter.table.reshape(-1, 2 * _SLOTS)
    most = parts.max(axis=1)
    full = np.flatnonzero(most)
    width = np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))
    for at in range(0, len(full), 256):
        ids = full[at : at + 256]
        payload = [pa.compress(parts[i].astype(f"<u{width[i]}").tobytes(), "zstd", asbytes=True) for i in ids]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(width[ids], pa.int32()), pa.array(payload, pa.binary())], names=["block", "width", "payload"])


def context_counts(docs: DataFrame, types: DataFrame, coder, text: str = "text") -> DataFrame:
    """(block, first, second, logits): int8 logits of each block's slots, counted over all texts and spelled words (``types``: token).

    ``docs`` and ``types`` are dealt to two halves (``half``: boolean); ``first`` and ``second`` are the logits of one half alone.
    """
    def in_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, table = coder.value, _Counter(coder.value.table_bits)
        end = int(c.symbols(pa.array([END], pa.large_binary()))[0])
        for part, code, _, known, row in _parts(batches, text, c):
            symbol, _, place = _with_ends(known[code] if len(code) else code, row, part.num_rows, end)
            table.add(c.word_events(symbol, place))
        yield from _table_rows(table)

    def in_types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, table = coder.value, _Counter(coder.value.table_bits)
        for part in chunks(batches, "token", _EVENTS):
            table.add(c.byte_events(*binary_parts(part.column("token").cast(pa.large_binary()))))
        yield from _table_rows(table)

    def logits(n: np.ndarray) -> bytes:
        zero, one = n[::2], n[1::2]
        return np.clip(np.rint(np.log((one + 0.4) / (zero + 0.4)) * 16), -127, 127).astype(np.int8).tobytes()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, width, payload, half in zip(*(batch.column(x).to_pylist() for x in ("block", "width")), batch.column("payload"), batch.column("half").to_pylist()):
                n = sums[block] if block in sums else sums.setdefault(block, np.zeros((2, 2 * _SLOTS), np.int64))
                n[int(half)] += np.frombuffer(pa.decompress(payload.as_buffer(), 2 * width * _SLOTS, "zstd"), f"<u{width}")
        for block, n in sums.items():
            columns = [pa.array([block], pa.int32()), *(pa.array([logits(x)], pa.binary()) for x in (n[0], n[1], n[0] + n[1]))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "first", "second", "logits"])

    def counted(df: DataFrame, column: str, run, half: bool) -> DataFrame:
        own = df.where(F.col("half") == half).select(F.col(f"`{column}`"))
        return own.mapInArrow(run, "block int, width int, payload binary").withColumn("half", F.lit(half))

    partial = [counted(df, column, run, half) for df, column, run in ((docs, text, in_texts), (types, "token", in_types)) for half in (False, True)]
    return reduce(DataFrame.unionByName, partial).repartition("block").mapInArrow(total, "block int, first binary, second binary, logits binary")


class Model:
    """Coder, context logits and start weights; scores texts in a task."""

    def __init__(self, coder: Coder, tables: np.ndarray):
        self.coder, self.tables = coder, tables
        self.weights = np.tile(np.array([0.4, 0.3, 0.3, 0.1], np.float32), (_GATES, 1))
        # the more contexts are unseen, the more the others count
        self.weights[[0, 8]] = [1, 0, 0, 0]

    def _inputs(self, events, kind: int) -> tuple[np.ndarray, np.ndarray]:
        seen, gate = self._seen(events, kind)
        return self._floats(events[1], seen), gate

    def _seen(self, events, kind: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Each context's logits as stored, and the gates."""
        _, node, _, *slots = events
        seen = [table.take(slot) for table, slot in zip(self.tables, slots)]
        gate = np.full(len(node), 8 * kind, np.uint8)
        for k, got in enumerate(seen):
            gate += (got != 0).view(np.uint8) << np.uint8(k)
        return seen, gate

    def _floats(self, node: np.ndarray, seen: list[np.ndarray]) -> np.ndarray:
        x = np.empty((4, len(node)), np.float32)
        x[0] = self.coder.logit.take(node)
        for k, got in enumerate(seen):
            np.multiply(got, np.float32(1 / 16), out=x[k + 1])
        return x

    @staticmethod
    def _log10(logit: np.ndarray, bit: np.ndarray) -> np.ndarray:
        z = (logit * (1 - 2 * bit)).astype(np.float32).clip(-12, 12)
        return np.log1p(np.exp(z)) * np.float32(-1 / np.log(10))

    def spell(self, distinct: pa.LargeBinaryArray) -> np.ndarray:
        """log10 probability of spelling each word."""
        out = np.zeros(len(distinct))
        for at in range(0, len(distinct), 20_000):  # a slice's decisions fit in memory
            data, off = binary_parts(distinct.slice(at, 20_000))
            events = self.coder.byte_events(data, off)
            x, gate = self._inputs(events, 1)
            logit = (self.weights[gate].T * x).sum(axis=0)
            out[at : at + len(off) - 1] = np.bincount(events[0], self._log10(logit, events[2]), minlength=len(off) - 1)
        return out

    def score(self, symbol: np.ndarray, row: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
        """log10 probability of each text's path decisions, weights refined after every block of its words."""
        # all texts' first blocks, then all second blocks ...
        block = place // _BLOCK
        order = np.argsort(block, kind="stable")
        events = self.coder.word_events(symbol, place, order)
        x, gate = self._inputs(events, 0)
        of = row[order]
        gate_of = (of * _GATES).take(events[0])
        gate_of += gate
        sign = 1 - 2 * events[2].astype(np.float32)
        ends = np.searchsorted(events[0], np.cumsum(np.bincount(block)))  # a block's words follow those of the block before
        weights = np.tile(self.weights.T, (1, rows))  # of context k, text t and gate g: [k, t * _GATES + g]
        cost = np.empty(len(gate), np.float32)
        for a, b in zip([0, *ends], ends):
            v, y, key = x[:, a:b], sign[a:b], gate_of[a:b]
            odds = weights[0].take(key)
            odds *= v[0]
            for k in (1, 2, 3):
                term = weights[k].take(key)
                term *= v[k]
                odds += term
            odds *= y
            np.exp(odds.clip(-12, 12, out=odds), out=odds)  # of the other bit
            np.log1p(odds, out=cost[a:b])
            if b < len(gate):
                odds /= 1 + odds
                odds *= y
                odds *= np.float32(-_RATE)
                for k in range(4):
                    np.add.at(weights[k], key, odds * v[k])
        return np.bincount(of, np.bincount(events[0], cost, minlength=len(of)), minlength=rows) / -np.log(10)

    def by_gate(self, events, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs and bits of the decisions sorted by gate, and where each gate's begin."""
        seen, gate = self._seen(events, kind)
        order = np.argsort(gate, kind="stable")
        x = self._floats(events[1].take(order), [got.take(order) for got in seen])  # bytes are put in order, not floats
        return x, events[2].take(order).astype(np.float32), np.concatenate([[0], np.cumsum(np.bincount(gate, minlength=_GATES))])

    def slopes(self, x: np.ndarray, y: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By gate: the curvature H of the log likelihood at the present weights w, and H w + its gradient."""
        curve, pull = np.zeros((_GATES, 4, 4)), np.zeros((_GATES, 4))
        for g in np.flatnonzero(np.diff(cuts)):
            w = self.weights[g]
            for a in range(cuts[g], cuts[g + 1], _LANE):
                b = min(a + _LANE, cuts[g + 1])
                v = x[:, a:b]
                p = 1 / (1 + np.exp(-(w @ v).clip(-12, 12)))
                curve[g] += (v * (p * (1 - p))) @ v.T
                pull[g] += v @ (y[a:b] - p)
            pull[g] += curve[g] @ w
        return curve, pull

    def solved(self, curve: np.ndarray, pull: np.ndarray) -> np.ndarray:
        """The weights that such sums lead to, held a little to the present ones."""
        return np.stack([np.linalg.solve(h + 10 * np.eye(4), b + 10 * w) for h, b, w in zip(curve, pull, self.weights.astype(np.float64))]).astype(np.float32)


def _fit_weights(docs: DataFrame, types: DataFrame, models, text: str) -> np.ndarray:
    """Start weights from all texts and spelled words (``types``: token), each on the counts of the half it isn't in.

    Every task adds up the slopes of all its decisions, each part's at the weights
    that the parts before it lead to; the sums of all tasks are solved once.
    """

    def sums(kind: int, half: bool, column: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start = models.value[not half]
            m = Model(start.coder, start.tables)
            end = int(m.coder.symbols(pa.array([END], pa.large_binary()))[0])
            total = None
            def in_texts():
                for part, code, _, known, row in _parts(batches, column, m.coder):
                    symbol, _, place = _with_ends(known[code] if len(code) else code, row, part.num_rows, end)
                    yield m.coder.word_events(symbol, place)

            def in_types():
                for part in chunks(batches, column, _EVENTS):
                    yield m.coder.byte_events(*binary_parts(part.column(column).cast(pa.large_binary())))

            for events in in_types() if kind else in_texts():
                if not len(events[1]):
                    continue
                sorted_ = m.by_gate(events, kind)
                if total is None:
                    for _ in range(FIRST_STEPS):
                        m.weights += (start.solved(*m.slopes(*sorted_)) - m.weights).clip(-0.5, 0.5)
                found = m.slopes(*sorted_)
                total = found if total is None else (total[0] + found[0], total[1] + found[1])
                m.weights = start.solved(*total)
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in total], names=["curve", "pull"])

        return run

    parts = [
        df.where(F.col("half") == half).select(F.col(f"`{column}`")).mapInArrow(sums(kind, half, column), "curve binary, pull binary")
        for kind, df, column in ((0, docs, text), (1, types, "token"))
        for half in (False, True)
    ]
    curve, pull = np.zeros((_GATES, 4, 4)), np.zeros((_GATES, 4))
    for r in reduce(DataFrame.unionByName, parts).collect():  # 3 kB of each task
        curve += np.frombuffer(bytes(r["curve"])).reshape(curve.shape)
        pull += np.frombuffer(bytes(r["pull"])).reshape(pull.shape)
    return models.value[0].solved(curve, pull)


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether crc32(key as text) mod folds is fold; a null key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def score_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", folds: int = 10, fold: int = 0) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte), a row for each row of ``docs``.

    The model learns from the rows outside the held-out fold; a null key counts
    as outside. Null texts are empty: the end alone is scored. Repeated rows are
    scored alike and listed as often. With no training rows at all the tree has
    the end and the escape only, and words are spelled with untrained contexts.
    Other columns are not read.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    train = docs.where(~held_out(F.col("key"), folds, fold))

    counts = scratch.write(word_counts(train), "word-counts")
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("once"), F.count(F.when(F.col("c") == 2, 1)).alias("twice")).first()
    # the tree: all words above a count, as many as fit; found from a histogram of logarithms. Words seen
    # once stand for those that a new text has first: they take the escape
    level = F.floor(F.log2("c") * 8)
    is_word = F.col("token") != F.lit(END)
    fits = is_word & (F.octet_length("token") <= TREE_WORD_BYTES) & (F.col("c") > 1)
    least, held = None, 0
    for r in counts.where(fits).groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():
        held += r["n"]
        if held > TREE_WORDS:
            break
        least = r["level"]
    is_tree = fits & (level >= least) if least is not None else F.lit(False)
    top = counts.where(is_tree).orderBy(F.desc("c"), "token").collect()  # TREE_WORDS at most
    end = counts.where(F.col("token") == F.lit(END)).collect()
    tree = [(END, end[0]["c"] if end else 1), *((bytes(r["token"]), r["c"]) for r in top)]
    in_tree = sum(c for _, c in tree) if whole["n"] else 0
    rare = whole["n"] - in_tree
    bits = min(max(int(whole["n"]).bit_length() + 3, LEAST_BITS), MOST_BITS)
    coder = sc.broadcast(Coder(tree, max(rare, whole["once"]), bits))
    rare_words = counts.where(is_word & ~is_tree)
    # Good-Turing: words seen once predict the novel ones, words seen twice those seen once
    known_rare = 2 * whole["twice"] + rare - whole["once"]
    novel = (whole["once"] + 1) / (whole["once"] + known_rare + 2)

    # all training texts fit the mixer, each on the context counts of the half that it isn't in
    halves = lambda df, *by: df.withColumn("half", F.xxhash64(*by) % 2 != 0)
    train = halves(train, "key", "text")
    spelled = halves(rare_words.where("c <= 2") if rare else counts.where(is_word), "token")
    blocks = context_counts(train, spelled, coder).collect()  # 9 x 2**MOST_BITS bytes at most
    tables = {}
    for which in ("first", "second", "logits"):
        tables[which] = np.zeros(_CONTEXTS << bits, np.int8)
        for b in blocks:
            tables[which][b["block"] * _SLOTS : (b["block"] + 1) * _SLOTS] = np.frombuffer(bytes(b[which]), np.int8)
        tables[which] = tables[which].reshape(_CONTEXTS, -1)
    weights = _fit_weights(train, spelled, sc.broadcast([Model(coder.value, tables[x]) for x in ("first", "second")]), "text")
    model = Model(coder.value, tables["logits"])
    model.weights = weights
    shared = sc.broadcast(model)
    n, v = whole["n"], whole["v"]
    divisor = float(np.log10(n + 0.1 * (v + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        c = m.coder
        base = np.append(np.log10(c.counts + 0.1) - divisor, 0.0)
        stop = int(c.symbols(pa.array([END], pa.large_binary()))[0])
        for part, code, distinct, known, row in _parts(batches, "text", c):
            rows = part.num_rows
            symbol, text_row, place = _with_ends(known[code] if len(code) else code, row, rows, stop)
            score = m.score(symbol, text_row, place, rows)
            of_row = lambda x: np.bincount(text_row, x, minlength=rows)
            # a row for each text, then one for each of its distinct words outside the tree
            out = np.flatnonzero(known == c.escape)
            place_of = np.full(len(distinct) + 1, -1, np.int64)
            place_of[out] = np.arange(len(out))
            rare_code = place_of[code] if len(code) else code
            picked = rare_code >= 0
            pair, times = np.unique(row[picked] * max(len(out), 1) + rare_code[picked], return_counts=True)
            of, which = pair // max(len(out), 1), pair % max(len(out), 1)
            rare_texts = distinct.take(pa.array(out))
            # every word of a training text is counted: only those of held-out texts can be novel
            apart = part.column("apart").to_numpy(zero_copy_only=False)
            novel = np.unique(which[apart[of]])
            spelled_score = np.zeros(len(out))
            spelled_score[novel] = m.spell(rare_texts.take(pa.array(novel)))
            data_len = pc.fill_null(pc.binary_length(part.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            own_key = pa.concat_arrays([part.column("key"), part.column("key").take(pa.array(of))])
            own_number = pa.concat_arrays([part.column("number"), part.column("number").take(pa.array(of))])
            unique = pa.array([END + b"%d" % i for i in part.column("number").to_pylist()], pa.binary())
            zeros, n_rare = np.zeros(len(of), np.int64), len(of)
            yield pa.RecordBatch.from_arrays(
                [
                    own_key,
                    own_number,
                    pa.concat_arrays([unique, rare_texts.take(pa.array(which)).cast(pa.binary())]),
                    pa.array(np.concatenate([np.zeros(rows, np.int64), times]), pa.int64()),
                    pa.array(np.concatenate([of_row(np.ones(len(symbol))).astype(np.int64), zeros])),
                    pa.array(np.concatenate([of_row(np.append(c.counts > 0, False)[symbol] if n else np.zeros(len(symbol))).astype(np.int64), zeros])),
                    pa.array(np.concatenate([of_row(base[symbol]) if n else of_row(np.full(len(symbol), np.log10(0.1) - divisor)) * 1.0, np.zeros(n_rare)])),
                    pa.array(np.concatenate([score, spelled_score[which]])),
                    pa.array(np.concatenate([data_len, zeros])),
                ],
                names=["key", "number", "token", "times", "n_tokens", "n_known", "base", "score", "n_bytes"],
            )

    kind = docs.schema["key"].dataType.simpleString()
    # a number for each row, the same if a task that reads it runs again
    numbered = docs.withColumn("number", F.monotonically_increasing_id()).withColumn("apart", held_out(F.col("key"), folds, fold))
    rows = numbered.mapInArrow(run, f"key {kind}, number long, token binary, times long, n_tokens long, n_known long, base double, score double, n_bytes long")
    # a row for each word, evenly dealt: a hash join leaves the texts' many rows unsorted
    rows = rows.join(counts.hint("shuffle_hash"), "token", "left")
    t, c = F.col("times"), F.col("c")
    is_text = t == 0
    gained = F.when(is_text, F.col("score")).when(c.isNull(), t * (F.lit(float(np.log10(novel))) + F.col("score"))).otherwise(t * (F.lit(float(np.log10(1 - novel))) + F.log10(c) - F.lit(float(np.log10(max(rare, 1))))))
    base = F.when(is_text, F.col("base")).otherwise(t * (F.log10(F.coalesce(c, F.lit(0)) + 0.1) - F.lit(divisor)))
    known = F.when(is_text, F.col("n_known")).when(c.isNull(), 0).otherwise(t)
    per = rows.groupBy("number", "key").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum(known).alias("n_known"), F.sum(base).alias("base_score"), F.sum(gained).alias("score"), F.sum("n_bytes").alias("n_bytes")
    )
    return per.select(
        F.col("key").alias(key),
        held_out(F.col("key"), folds, fold).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "n_bytes",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
