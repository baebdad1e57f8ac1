"""SentencePiece encoding and decoding (operator 3): sampled segmentations, lossless decoding.

A text is segmented over the lattice of all vocabulary pieces by forward filtering and backward
sampling: the forward pass sums the weights of all ways to reach each position, the backward
pass draws the last piece of each prefix in proportion. Random numbers are a hash of (seed, row
key, position), so a row's segmentation is the same in every run and partitioning.

No piece holds white space after another character, so every path passes the start of each run
of spaces: the lattice falls apart there into segments ("words" with their leading spaces) that
are filtered once for each distinct one and sampled for every occurrence, vectorised in numpy.
A segment falls apart further at every place that no piece of its lattice crosses (between two
characters without a common piece, as in most text without spaces); a stretch of more than
LONG_STRETCH characters without such a place is filtered node by node.

Weights come from the vocabulary's order, not from training: a piece of merge rank r has weight
(r + 2) ** -alpha. Characters without a piece are written as their UTF-8 bytes. Spaces are
matched by the vocabulary's space mark; a mark that stands in the text itself is written as
bytes, so decoding gives back every text exactly.

Defined cases: a null text gives null pieces and null decoded text; an empty one an empty array;
repeated rows with equal keys get equal segmentations; a null key is a key of its own; an empty
table gives no rows; other columns are carried, clashing names give way to the result's.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmine.llm.common import quoted, read

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SEED = 11
SLICE_CHARS = 2_000_000  # characters sampled at a time in a task
LATTICE_CHARS = 50_000  # characters of distinct segments filtered at a time: what the caches hold
LONG_STRETCH = 256     # a longer stretch of the lattice is filtered node by node
FEW_DRAWS = 24         # fewer live stretches are drawn one by one
_MARK = "▁"
_MUL = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces, weights and lookups; small (bounded by the model file), broadcast to tasks."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], special: set[int],
                 alpha: float = ALPHA):
        self.text: list[bytes] = []
        usable: list[tuple[str, int]] = []
        byte_of = {piece: b for b, piece in enumerate(byte_ids)}
        for i, p in enumerate(pieces):
            if i in byte_of:
                self.text.append(bytes([byte_of[i]]))
            elif i in special:
                self.text.append(b"")
            else:
                plain = p.replace(_MARK, " ")
                if re.search(r"[^ ] ", plain) or "\n" in plain:
                    raise ValueError(f"piece {i} holds white space inside; segments would not part there")
                self.text.append(plain.encode())
                usable.append((plain, i))
        self.byte_ids = np.array(byte_ids, np.int32)
        rank = np.maximum(0.0, -np.array(scores))
        self.weight = -alpha * np.log(rank + 2.0)
        self.byte_weight = -alpha * np.log(len(pieces) + 2.0)
        # Every prefix of a piece by hash, with the piece's id where it is one: a trie in an open
        # hash table (linear probing, at most ``probes`` steps).
        prefixes: dict[int, int] = {}
        for plain, i in usable:
            h = 0
            for k, c in enumerate(plain):
                h = ((h ^ (ord(c) + 1)) * int(_MUL)) & (2**64 - 1)
                h ^= h >> 29
                prefixes.setdefault(h, -1)
                if k == len(plain) - 1:
                    prefixes[h] = i
        slots = 1 << max(10, (8 * len(prefixes) - 1).bit_length())
        self.shift = np.uint64(64 - slots.bit_length() + 1)
        self.keys, self.ids, self.probes = np.zeros(slots + 64, np.uint64), np.full(slots + 64, -2, np.int32), 1
        for h, i in prefixes.items():
            at = first = h >> int(self.shift)
            while self.ids[at] != -2:
                at += 1
            self.keys[at], self.ids[at] = h, i
            self.probes = max(self.probes, at - first + 1)
        self.longest = max(len(p) for p, _ in usable)

    @classmethod
    def load(cls, path: str = MODEL, alpha: float = ALPHA) -> Vocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        pieces = [m.id_to_piece(i) for i in range(n)]
        by_name = {p: i for i, p in enumerate(pieces)}
        byte_ids = [by_name[f"<0x{b:02X}>"] for b in range(256)]
        special = {i for i in range(n) if m.is_control(i) or m.is_unknown(i) or m.is_unused(i)}
        return cls(pieces, [m.get_score(i) for i in range(n)], byte_ids, special, alpha)

    @classmethod
    def restored(cls, state: dict) -> Vocabulary:
        """From ``vars`` of another: what is broadcast is plain data."""
        v = cls.__new__(cls)
        v.__dict__.update(state)
        return v

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Id of the piece with hash ``h``; -1: only a prefix of pieces; -2: neither."""
        at = (h >> self.shift).astype(np.int64)
        out = np.where(self.keys[at] == h, self.ids[at], -2)
        todo = np.flatnonzero((out == -2) & (self.ids[at] != -2))
        for _ in range(1, self.probes):
            if not len(todo):
                break
            at[todo] += 1
            spot = at[todo]
            out[todo] = np.where(self.keys[spot] == h[todo], self.ids[spot], -2)
            todo = todo[(out[todo] == -2) & (self.ids[spot] != -2)]
        return out

    def decode(self, ids) -> str:
        """The text of a row's pieces, exactly as it was encoded."""
        return b"".join(map(self.text.__getitem__, ids))[1:].decode("utf-8") if len(ids) else ""


_SEGMENT = re.compile(r" +[^ \n]*|[^ \n]+|\n")


class _Lattice:
    """Filtered lattice of distinct segments: for each node, its incoming edges with integer
    cumulative probabilities (deterministic whatever else is in the batch)."""

    def __init__(self, vocab: Vocabulary, segments: list[str]):
        lens = np.array([len(s) for s in segments], np.int32)
        chars = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        n = len(chars)
        seg = np.repeat(np.arange(len(segments), dtype=np.int32), lens)
        first = (np.cumsum(lens) - lens).astype(np.int32)
        local = np.arange(n, dtype=np.int32) - first[seg]
        left = lens[seg] - local  # characters from here to the segment's end
        self.first_node = first + np.arange(len(segments), dtype=np.int32)  # len + 1 nodes a segment
        self.lens = lens
        starts, ends, ids = [], [], []
        at, h = np.arange(n, dtype=np.int32), np.zeros(n, np.uint64)
        single = np.zeros(n, bool)
        with np.errstate(over="ignore"):
            for k in range(vocab.longest):
                h = (h ^ (chars[at + k].astype(np.uint64) + np.uint64(1))) * _MUL
                h ^= h >> np.uint64(29)
                piece = vocab.lookup(h)
                hit = piece > -2
                at, h, piece = at[hit], h[hit], piece[hit]
                whole = piece >= 0
                starts.append(at[whole])
                ends.append(at[whole] + k + 1)
                ids.append(piece[whole])
                if k == 0:
                    single[at[whole]] = True
                more = left[at] > k + 1
                at, h = at[more], h[more]
                if not len(at):
                    break
        bare = np.flatnonzero(~single).astype(np.int32)  # no piece of its own: UTF-8 bytes
        size = 1 + (chars[bare] > 0x7F).astype(np.int32) + (chars[bare] > 0x7FF) + (chars[bare] > 0xFFFF)
        start = np.concatenate([*starts, bare])
        end_local = local[start] + np.concatenate([*ends, bare + 1]) - start
        piece = np.concatenate([*ids, np.full(len(bare), -1, np.int32)])
        weight = np.concatenate([vocab.weight[np.concatenate(ids)], vocab.byte_weight * size])
        node0 = start + seg[start]
        node1 = self.first_node[seg[start]] + end_local
        del starts, ends, ids, at, h, single, left, end_local
        order = np.argsort(node1.astype(np.int64) * 64 + np.minimum(node1 - node0, 63)).astype(np.int32)
        self.node0, node1, self.piece = node0[order], node1[order], piece[order]
        weight, self.char = weight[order], chars[start[order]]
        nodes, edges = n + len(segments), len(order)
        del order, start, piece, seg, local, node0
        self.first_edge = np.zeros(nodes + 1, np.int32)
        np.cumsum(np.bincount(node1, minlength=nodes), out=self.first_edge[1:])
        # Cuts: nodes that no edge passes over. Every path visits them, so a stretch between two
        # is filtered from its own start.
        wide = np.flatnonzero(node1 - self.node0 > 1)
        over = np.bincount(self.node0[wide] + 1, minlength=nodes) - np.bincount(node1[wide], minlength=nodes)
        is_cut = np.cumsum(over) == 0
        self.cuts = np.flatnonzero(is_cut).astype(np.int32)
        del over, wide
        last_cut = np.zeros(nodes, np.int32)
        last_cut[self.cuts] = self.cuts
        base = np.maximum.accumulate(last_cut)[node1 - 1]
        step = node1 - base
        alpha = np.zeros(nodes)
        prob = np.empty(edges)
        gaps = np.diff(self.cuts) > LONG_STRETCH
        long = np.zeros(nodes, bool)
        long[self.cuts[:-1][gaps]] = True
        # Forward filtering, by distance from the stretch's start; edges stay in node order.
        if gaps.any():
            short = np.flatnonzero(~long[base]).astype(np.int32)
            by_step = short[np.argsort(step[short].astype(np.uint16), kind="stable")]
        else:
            by_step = np.argsort(step.astype(np.uint16), kind="stable").astype(np.int32)
        for lo, hi in _runs(step[by_step]):
            e = by_step[lo:hi]
            v = alpha[self.node0[e]] + weight[e]
            to = node1[e]
            fresh = np.empty(hi - lo, bool)
            fresh[0] = True
            np.not_equal(to[1:], to[:-1], out=fresh[1:])
            cut = np.flatnonzero(fresh)
            if len(cut) == hi - lo:  # one edge to each node
                alpha[to] = np.where(is_cut[to], 0.0, v)
                prob[e] = 1.0
                continue
            own = np.cumsum(fresh) - 1
            top = np.maximum.reduceat(v, cut)
            v = np.exp(v - top[own])
            total = np.add.reduceat(v, cut)
            ends_at = to[cut]
            alpha[ends_at] = np.where(is_cut[ends_at], 0.0, top + np.log(total))
            prob[e] = v / total[own]
        for k in np.flatnonzero(gaps):
            self._filter_long(int(self.cuts[k]), int(self.cuts[k + 1]), weight, prob)
        # Integer cumulative probabilities within each node.
        rank = np.arange(edges) - self.first_edge[node1]
        for lo, hi in _runs(rank[by_rank := np.argsort(rank.astype(np.uint16), kind="stable")]):
            if lo:
                sel = by_rank[lo:hi]
                prob[sel] += prob[sel - 1]
        self.part = np.minimum(np.floor(prob * 2.0**32), 2.0**32).astype(np.uint64)
        self.part[np.r_[node1[1:] != node1[:-1], True]] = 1 << 32

    @classmethod
    def joined(cls, parts: list[_Lattice]) -> _Lattice:
        """One lattice of the segments of all ``parts``; nothing depends on how they were dealt."""
        nodes = np.cumsum([0] + [len(p.first_edge) - 1 for p in parts]).astype(np.int32)
        edges = np.cumsum([0] + [len(p.piece) for p in parts]).astype(np.int32)
        lat = cls.__new__(cls)
        for name in ("lens", "piece", "char", "part"):
            setattr(lat, name, np.concatenate([getattr(p, name) for p in parts]))
        for name in ("first_node", "node0", "cuts"):
            setattr(lat, name, np.concatenate([getattr(p, name) + n for p, n in zip(parts, nodes, strict=False)]))
        lat.first_edge = np.concatenate([*[p.first_edge[:-1] + n for p, n in zip(parts, edges, strict=False)], edges[-1:]])
        return lat

    def _filter_long(self, start: int, stop: int, weight: np.ndarray, prob: np.ndarray) -> None:
        """Probabilities of the edges between two cuts, node by node; chosen by the stretch's own
        length, so that a text's samples do not depend on its neighbours."""
        first = self.first_edge[start + 1:stop + 2].tolist()
        lo, hi = first[0], first[-1]
        origin, gain = (self.node0[lo:hi] - start).tolist(), weight[lo:hi].tolist()
        alpha, out = [0.0], []
        exp, log = math.exp, math.log
        for a, b in zip(first[:-1], first[1:], strict=True):
            v = [alpha[origin[e]] + gain[e] for e in range(a - lo, b - lo)]
            top = max(v)
            v = [exp(x - top) for x in v]
            total = sum(v)
            alpha.append(top + log(total))
            out += [x / total for x in v]
        prob[lo:hi] = out

    def parts(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the words the stretches between cuts: (place of the word, first node, last node)."""
        lo = np.searchsorted(self.cuts, self.first_node).astype(np.int32)  # both ends of a word are cuts
        many = np.diff(np.r_[lo, len(self.cuts)]).astype(np.int32) - 1
        per = many[word]
        owner = np.repeat(np.arange(len(word), dtype=np.int32), per)
        at = np.arange(len(owner), dtype=np.int32) - np.repeat((np.cumsum(per) - per).astype(np.int32), per)
        at += lo[word][owner]
        return owner, self.cuts[at], self.cuts[at + 1]

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """For each node and 32-bit number the edge drawn."""
        edge = self.first_edge[node]
        todo = np.flatnonzero(self.part[edge] <= u)
        while len(todo):
            edge[todo] += 1
            todo = todo[self.part[edge[todo]] <= u[todo]]
        return edge

    def draw_stretch(self, start: int, node: int, seed: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """The edges drawn from ``node`` back to ``start`` and their first nodes; draws as :meth:`draw` does."""
        low = int(self.first_edge[start])
        high = int(self.first_edge[node + 1])
        first = self.first_edge[start:node + 1].tolist()
        part, origin = self.part[low:high].tolist(), self.node0[low:high].tolist()
        at = np.arange(start, node + 1, dtype=np.int64) + shift
        with np.errstate(over="ignore"):
            numbers = (_mix(np.uint64(seed) + at.astype(np.uint64) * _MUL) >> np.uint64(32)).tolist()
        drawn = []
        while node > start:
            u, e = numbers[node - start], first[node - start] - low
            while part[e] <= u:
                e += 1
            drawn.append(e + low)
            node = origin[e]
        edge = np.array(drawn, np.int32)
        return edge, self.node0[edge].astype(np.int64)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal neighbours."""
    if len(values):
        cuts = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, len(values)]
        yield from zip(cuts[:-1], cuts[1:], strict=True)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def encode_rows(vocab: Vocabulary, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of all texts end to end, and how many each text has. ``keys``: uint64 a row."""
    table: defaultdict[str, int] = defaultdict()
    table.default_factory = table.__len__  # a new segment gets the next number
    words, rows = [np.zeros(0, np.int32)], []
    for text in texts:
        found = _SEGMENT.findall(" " + text) if text else []
        words.append(np.fromiter(map(table.__getitem__, found), np.int32, len(found)))
        rows.append(len(found))
    word = np.concatenate(words)
    if not len(word):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    segments = list(table)
    lat = _Lattice.joined([_Lattice(vocab, segments[lo:hi]) for lo, hi in _slices([len(s) for s in segments], LATTICE_CHARS)])
    del words, table, segments
    row = np.repeat(np.arange(len(texts), dtype=np.int32), rows)
    upto = np.cumsum(lat.lens[word]) - lat.lens[word]
    row_first = np.cumsum(np.r_[0, rows])[:-1]
    base = np.r_[upto, 0][np.minimum(row_first, len(upto) - 1)]
    offsets = upto - base[row]  # characters before the segment in its row
    seeds = _mix(keys)
    shift = (offsets - lat.first_node[word]).astype(np.int64)  # of a node to its place in the row
    global_shift = (upto - lat.first_node[word]).astype(np.int64)
    live, stop, node = lat.parts(word)  # the place of its word, first and current node of each stretch
    places, edges, owners = [], [], []
    while len(live) >= FEW_DRAWS:
        with np.errstate(over="ignore"):
            u = _mix(seeds[row[live]] + (shift[live] + node).astype(np.uint64) * _MUL) >> np.uint64(32)
        edge = lat.draw(node, u)
        node = lat.node0[edge]
        places.append(global_shift[live] + node)
        edges.append(edge)
        owners.append(row[live])
        on = np.flatnonzero(node > stop)
        live, stop, node = live[on], stop[on], node[on]
    for w, lo, hi in zip(live.tolist(), stop.tolist(), node.tolist(), strict=True):
        edge, at = lat.draw_stretch(lo, hi, int(seeds[row[w]]), int(shift[w]))
        edges.append(edge)
        places.append(global_shift[w] + at)
        owners.append(np.full(len(edge), row[w], np.int32))
    place, edge = np.concatenate(places), np.concatenate(edges)
    order = np.argsort(place, kind="stable")
    edge, owner = edge[order], np.concatenate(owners)[order]
    piece, char = lat.piece[edge], lat.char[edge]
    bare = piece < 0
    if not bare.any():
        return piece, np.bincount(owner, minlength=len(texts))
    size = np.where(bare, 1 + (char > 0x7F).astype(np.int64) + (char > 0x7FF) + (char > 0xFFFF), 1)
    out = np.repeat(piece, size)
    raw = char[bare].astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    out[np.repeat(bare, size)] = vocab.byte_ids[np.frombuffer(raw, np.uint8)]
    return out, np.bincount(np.repeat(owner, size), minlength=len(texts))


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    at, total = 0, 0
    for i, s in enumerate(sizes):
        if total and total + s > most:
            yield at, i
            at, total = i, 0
        total += s
    if at < len(sizes):
        yield at, len(sizes)


def _row_keys(name: str, seed: int) -> F.Column:
    return F.xxhash64(F.lit(seed), F.col(name))


def encode(docs: DataFrame, text: str = "text", key: str = "doc_id", model: str = MODEL,
           alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """``docs`` with ``pieces`` (array of ids), ``n_pieces`` and ``lossless``.

    Each row is decoded again in its task; ``lossless`` says whether that gave the same text.
    """
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(vars(Vocabulary.load(model, alpha)))
    made = ("pieces", "n_pieces", "lossless")
    own = [c for c in docs.columns if c.lower() not in made]
    keyed = docs.select(*map(quoted, own), _row_keys(key, seed).alias("__key"))
    # Columns travel by place: names with dots are no attributes to mapInArrow.
    places = [f"c{i}" for i in range(len(own))]
    schema = T.StructType([T.StructField(p, keyed.schema[i].dataType) for i, p in enumerate(places)]).add("pieces", T.ArrayType(T.IntegerType())).add(
        "n_pieces", T.LongType()).add("lossless", T.BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary.restored(vocab.value)
        for batch in batches:
            texts = batch.column(own.index(text)).cast(pa.string())
            keys = np.ascontiguousarray(batch.column(len(own)).to_numpy(zero_copy_only=False)).view(np.uint64)
            plain = texts.to_pylist()
            for lo, hi in _slices([len(t or "") for t in plain], SLICE_CHARS):
                part = [t or "" for t in plain[lo:hi]]
                ids, counts = encode_rows(v, part, keys[lo:hi])
                ends = np.cumsum(counts)
                same = [v.decode(ids[e - c:e].tolist()) == t for t, c, e in zip(part, counts, ends, strict=True)]
                gone = np.array([t is None for t in plain[lo:hi]])
                offsets = pa.array(np.r_[0, ends].astype(np.int32), mask=np.r_[gone, False])
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                cols = [batch.column(i).slice(lo, hi - lo) for i in range(len(own))]
                yield pa.RecordBatch.from_arrays(
                    [*cols, lists, pa.array(counts, pa.int64(), mask=gone), pa.array(same, pa.bool_(), mask=gone)],
                    names=[*places, *made])

    return keyed.toDF(*places, "__key").mapInArrow(run, schema).toDF(*own, *made)


def decode(coded: DataFrame, pieces: str = "pieces", model: str = MODEL) -> DataFrame:
    """``coded`` with ``decoded``, the text of its pieces (null pieces: null)."""
    vocab = coded.sparkSession.sparkContext.broadcast(vars(Vocabulary.load(model)))

    @F.pandas_udf("string")
    def text_of(ids):
        v = Vocabulary.restored(vocab.value)
        return ids.map(lambda x: None if x is None else v.decode(x.tolist() if hasattr(x, "tolist") else x))

    return coded.withColumn("decoded", text_of(pieces))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "pieces", "n_pieces", "lossless")
