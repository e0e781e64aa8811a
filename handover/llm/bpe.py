"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A word is encoded from the left. At each position the automaton gives the
longest vocabulary token that starts there (the goto function of an Aho-Corasick
automaton, walked for all positions at once). A token may follow another one
only if the merge rules would leave that pair of tokens apart; this pair
compatibility is decided by undoing merges of the two tokens, latest first. When
no shorter match is compatible either, the last token is taken back and its end
is marked dead, so each position fails once and the work is linear. The one
token sequence whose neighbours are all compatible is what the merges give.

All distinct words of a chunk are encoded together: every numpy step advances
each unfinished word by one decision.

Decoding gathers the bytes of each id from one byte table with offsets.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from handover.llm.batches import binary_parts, chunks, codes, ragged, strings, text_bytes

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in table:
            table[b], extra = chr(extra), extra + 1
    return [table[b] for b in range(256)]


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point for the pre-tokenizer: letter, number, white space, other."""
    kinds = {"L": _LETTER, "N": _NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    # Unicode White_Space (fixed values)
    out[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return out


def _pieces(data: np.ndarray, seg: np.ndarray) -> np.ndarray:
    """Byte starts of the pre-tokens of all segments (offsets ``seg``, none empty).

    Splits as ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``:
    runs of one class, a single space going with the run after it, and the last
    of several white-space characters standing alone or with the next run.
    """
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(cp)
    kind = _classes()[cp]
    begin = np.zeros(n + 1, bool)
    begin[np.searchsorted(at, seg[:-1])] = True
    begin[n] = True
    blank = cp == 0x20
    starts = begin[:n].copy()
    starts[1:] |= (kind[1:] != kind[:-1]) & ~blank[:-1]
    space = kind == _SPACE
    starts[1:] |= space[1:] & ~space[:-1]
    starts[:-1] |= space[:-1] & ~space[1:] & ~begin[1:n]
    quote = np.flatnonzero((cp == 0x27) & starts)
    if len(quote):
        pad = np.concatenate([cp, np.zeros(3, np.uint32)])
        inside = np.concatenate([begin, np.ones(3, bool)])
        a, b = pad[quote + 1], pad[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"]) & ~inside[quote + 1]
        pairs = [(ord(x), ord(y)) for x, y in ("re", "ve", "ll")]
        two = functools.reduce(np.logical_or, [(a == x) & (b == y) for x, y in pairs]) & ~inside[quote + 1] & ~inside[quote + 2]
        for found, size in ((quote[one], 2), (quote[two], 3)):
            starts[found + 1] = False
            after = found + size
            starts[after[after < n]] = True
    return at[starts]


_FEW = 16


class BpeCodec:
    """Byte-level BPE vocabulary read from a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        back = {c: b for b, c in enumerate(byte_alphabet())}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        # internal numbers: bytes 0-255, then merges in order
        own = {c: b for c, b in back.items()}
        left, right = [*range(256)], [*range(256)]
        for a, b in merges:
            left.append(own[a])
            right.append(own[b])
            if a + b in own:
                raise ValueError(f"two merges make {a + b!r}: not a vocabulary for this encoder")
            own[a + b] = len(left) - 1
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)
        self.external = np.zeros(len(left), np.int64)
        raw: list[bytes] = [b""] * len(left)
        for s, t in own.items():
            self.external[t] = vocab[s]
            raw[t] = bytes(back[c] for c in s)
        self.length = np.array([len(x) for x in raw], np.int64)
        pair = (self.left[256:] << 20) | self.right[256:]
        order = np.argsort(pair)
        self.pair_key, self.pair_token = pair[order], order.astype(np.int64) + 256
        self._automaton(raw)
        self.special = {x["content"].encode(): x["id"] for x in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.special.values()])
        table = [b""] * size
        for t, x in enumerate(raw):
            table[self.external[t]] = x
        for x, i in self.special.items():
            table[i] = x
        self.bytes_off = np.zeros(size + 1, np.int64)
        np.cumsum([len(x) for x in table], out=self.bytes_off[1:])
        self.bytes_flat = np.frombuffer(b"".join(table), np.uint8)
        self.special_pattern = re.compile(b"|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True))) if self.special else None

    def _automaton(self, raw: list[bytes]) -> None:
        """Goto function as sorted edges, the token of each state, and each token's next shorter prefix token."""
        child: dict[int, int] = {}
        token = [-1]
        shorter = np.full(len(raw), -1, np.int64)
        for t in sorted(range(len(raw)), key=lambda t: len(raw[t])):
            state, seen = 0, -1
            for b in raw[t]:
                nxt = child.get(state << 8 | b)
                if nxt is None:
                    nxt = child[state << 8 | b] = len(token)
                    token.append(-1)
                state = nxt
                if token[state] >= 0:
                    seen = token[state]
            token[state] = t
            shorter[t] = seen
        self.edge_key = np.array(sorted(child), np.int64)
        self.edge_to = np.array([child[k] for k in self.edge_key.tolist()], np.int64)
        self.state_token, self.shorter = np.array(token, np.int64), shorter
        self.root = np.array([child[b] for b in range(256)], np.int64)
        # the first two bytes by a dense table
        self.root2 = np.full(65536, -1, np.int64)
        two = self.edge_key >> 8
        from_root = {int(s): b for b, s in enumerate(self.root)}
        for k, to in zip(self.edge_key[np.isin(two, self.root)].tolist(), self.edge_to[np.isin(two, self.root)].tolist()):
            self.root2[from_root[k >> 8] << 8 | k & 255] = to

    def longest(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Longest token that starts at each byte and ends inside its word."""
        best = self.state_token[self.root[data]]
        room = np.repeat(off[1:], np.diff(off)) - np.arange(len(data))
        at = np.flatnonzero(room > 1)
        state = self.root2[data[at].astype(np.int64) << 8 | data[at + 1]]
        depth = 2
        while True:
            live = state >= 0
            at, state = at[live], state[live]
            if not len(at):
                return best
            tok = self.state_token[state]
            best[at[tok >= 0]] = tok[tok >= 0]
            live = room[at] > depth
            at, state = at[live], state[live]
            key = state << 8 | data[at + depth]
            i = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
            state = np.where(self.edge_key[i] == key, self.edge_to[i], -1)
            depth += 1

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave token a and the token b after it apart.

        They join, if some merge across the border comes before the merges that
        make the parts at the border. The later-made part is undone first.
        """
        out = np.ones(len(a), bool)
        idx = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(idx):
            key = (a << 20) | b
            i = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            joins = (self.pair_key[i] == key) & (self.pair_token[i] < limit)
            out[idx[joins]] = False
            # undo the later-made of the two; a byte can't be undone, then the other one is
            undo_a = np.where(a > b, a > 255, (b <= 255) & (a > 255))
            undo_b = ~undo_a & (b > 255)
            limit = np.where(undo_a, a, np.where(undo_b, b + 1, limit))
            a = np.where(undo_a, self.right[a], a)
            b = np.where(undo_b, self.left[b], b)
            go = ~joins & (undo_a | undo_b)
            idx, a, b, limit = idx[go], a[go], b[go], limit[go]
        return out

    @functools.cached_property
    def _lists(self) -> tuple:
        """The tables as lists and a dictionary, for single steps."""
        pairs = dict(zip(self.pair_key.tolist(), self.pair_token.tolist()))
        left, right = self.left.tolist(), self.right.tolist()

        @functools.lru_cache(maxsize=1 << 16)
        def apart(a: int, b: int) -> bool:
            """``compatible`` of one pair."""
            limit = len(left)
            while True:
                if pairs.get(a << 20 | b, limit) < limit:
                    return False
                if a > b and a > 255:
                    a, limit = right[a], a
                elif b > 255:
                    b, limit = left[b], b + 1
                else:
                    return True

        return self.length.tolist(), self.shorter.tolist(), apart

    def _finish(self, best: list[int], alive: list[bool], stack: list[int], pos: int, tok: int) -> list[int]:
        """The steps of ``encode_words`` for one word from where it is; the word's tokens."""
        length, shorter, apart = self._lists
        while True:
            end = pos + length[tok]
            if alive[end] and (not stack or apart(stack[-1], tok)):
                stack.append(tok)
                if end == len(best):
                    return stack
                pos, tok = end, best[end]
            elif shorter[tok] >= 0:
                tok = shorter[tok]
            else:
                alive[pos] = False
                tok = stack.pop()
                pos -= length[tok]

    def encode_words(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """External ids of all words (none empty) end to end, and their number for each word."""
        n = len(off) - 1
        best = self.longest(data, off)
        alive = np.ones(len(data) + n, bool)  # ends of tokens, off[w] + w for word w's position 0
        stack = np.zeros(len(data), np.int64)
        depth = np.zeros(n, np.int64)
        w = np.arange(n)
        pos, tok = off[:-1].copy(), best[off[:-1]]
        while len(w):
            if len(w) <= _FEW:  # long words that are left: a step for all of them at once costs more than one for each
                for i, p, t in zip(w.tolist(), pos.tolist(), tok.tolist()):
                    a, b = int(off[i]), int(off[i + 1])
                    whole = self._finish(best[a:b].tolist(), alive[a + i : b + i + 1].tolist(), stack[a : a + depth[i]].tolist(), p - a, t)
                    depth[i] = len(whole)
                    stack[a : a + len(whole)] = whole
                break
            end = pos + self.length[tok]
            ok = alive[end + w]
            top = depth[w]
            check = np.flatnonzero(ok & (top > 0))
            ok[check] = self.compatible(stack[off[w[check]] + top[check] - 1], tok[check])
            # push
            g = np.flatnonzero(ok)
            stack[off[w[g]] + top[g]] = tok[g]
            depth[w[g]] += 1
            pos[g] = end[g]
            # a shorter match, or take the last token back
            f = np.flatnonzero(~ok)
            less = self.shorter[tok[f]]
            back = f[less < 0]
            tok[f] = less
            if len(back):
                alive[pos[back] + w[back]] = False
                depth[w[back]] -= 1
                last = stack[off[w[back]] + depth[w[back]]]
                tok[back] = last
                pos[back] -= self.length[last]
            done = ok & (pos == off[w + 1])
            more = g[~done[g]]
            tok[more] = best[pos[more]]
            w, pos, tok = w[~done], pos[~done], tok[~done]
        return self.external[stack[ragged(off[:-1], depth)]], depth

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of the texts."""
        data, off = text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
        seg, special = np.unique(off), {}
        if self.special_pattern is not None:
            raw = data.tobytes()
            if any(x in raw for x in self.special):
                cuts = set(seg.tolist())
                for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                    for m in self.special_pattern.finditer(raw, a, b):
                        special[m.start()] = self.special[m.group()]
                        cuts |= {m.start(), m.end()}
                seg = np.array(sorted(cuts), np.int64)
        start = _pieces(data, seg)
        if special:  # a special token is one piece
            inside = np.isin(seg[np.searchsorted(seg, start, "right") - 1], list(special))
            start = start[~inside | np.isin(start, seg)]
        length = np.diff(np.append(start, len(data)))
        code, distinct = codes(data, start, length)
        flat, count = self.encode_words(*binary_parts(distinct))
        first = np.cumsum(count) - count
        if special:
            at = np.searchsorted(start, list(special))
            flat = np.concatenate([flat, np.array(list(special.values()), np.int64)])
            code[at] = len(first) + np.arange(len(at))
            first = np.concatenate([first, len(flat) - len(at) + np.arange(len(at))])
            count = np.concatenate([count, np.ones(len(at), np.int64)])
        ids = flat[ragged(first[code], count[code])]
        ends = np.concatenate([[0], np.cumsum(count[code])])
        return ids, ends[np.searchsorted(start, off)]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> pa.Array:
        """Texts of the id lists; bytes that are not UTF-8 become U+FFFD."""
        length = self.bytes_off[ids + 1] - self.bytes_off[ids]
        flat = self.bytes_flat[ragged(self.bytes_off[ids], length)]
        ends = np.concatenate([[0], np.cumsum(length)])[off]
        try:
            flat.tobytes().decode("utf-8")
            whole = not (flat[ends[:-1][ends[:-1] < len(flat)]] & 0xC0 == 0x80).any()
        except UnicodeDecodeError:
            whole = False
        if whole:
            return strings(flat, ends)
        raw = flat.tobytes()
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string())


@functools.lru_cache(maxsize=2)
def codec(path: str) -> BpeCodec:
    """The codec of a file, made once per Python worker."""
    return BpeCodec(path)


def encode_decode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds the column ``ids`` (array of int) and, if named, ``decoded`` (the ids decoded again).

    ``path`` is a ``tokenizers`` JSON file of a byte-level BPE vocabulary, at the
    same place on every executor. Its special tokens in a text become their ids.
    A null or empty text has no ids and decodes to the empty text. Rows, repeated
    ones too, and all other columns stay as they are; existing columns of the new
    names are replaced. Narrow: no shuffle.
    """
    keep = [c for c in docs.columns if c not in (ids, decoded)]
    src = docs.select(*(F.col(f"`{c}`") for c in keep))
    schema = T.StructType([*src.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False)), *([T.StructField(decoded, T.StringType())] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for part in chunks(batches, text):
            flat, off = c.encode(part.column(text))
            cols = [*part.columns, pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat, pa.int32()))]
            if decoded:
                cols.append(c.decode(flat, off))
            yield pa.RecordBatch.from_arrays(cols, names=[*part.schema.names, ids, *([decoded] if decoded else [])])

    return src.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the text of the id list in ``ids``; a null list decodes to the empty text."""
    keep = [c for c in df.columns if c != decoded]
    src = df.select(*(F.col(f"`{c}`") for c in keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for part in batches:
            lists = part.column(ids)
            count = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64) if lists.null_count else np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            text = c.decode(flat, np.concatenate([[0], np.cumsum(count)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, decoded])

    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField(decoded, T.StringType())]))
