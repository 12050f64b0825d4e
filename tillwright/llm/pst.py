"""Language-model scoring with a probabilistic suffix tree over words.

Symbols are a text's words and one end. The root is the smoothed distribution of
single symbols (the base); a context is a run of up to three words. The tree's
statistics are the runs of symbols that occur ``least`` times or more in the training
texts, the same bar at every size of the corpus.

A context is retained if its next-symbol distribution diverges from that of its
longest retained suffix: by ``gain`` nats over its occurrences. It is smoothed by
absolute discounting towards that suffix, P(w | s) = (n(s, w) - d) / n(s) + rest(s)
* P(w | suffix), for the counted runs s w; all else is the suffix's. A text is
scored from the longest retained suffix of what stands before each symbol.

All contexts that end in one word, and all that their tests and smoothing need, lie in
one part of the tree, a branch. So texts are stored as symbols, in blocks of ``block`` bytes of text or less; a block
asks for the numbers of its words, and sends each branch its different windows of three
words and a next symbol, with the number of training occurrences and the documents they stand in.
A task grows its branches from the windows of all blocks and answers with one sum of
log10 P per document and task, held in single precision. Windows travel sorted, as differences,
in compressed columns of bytes. The branch of a word with more than ``hot`` training occurrences is dealt to several
tasks by the word before; the pairs that the word begins are then counted on their own, and
each of the tasks gets the word's distribution. No task holds more than its share of the
windows, which are summed per block, and nothing of the tree passes through the driver.

Null texts are empty (an end only). A null doc_id counts as the empty id in the
hold-out rule. Repeated rows are scored, and learned from, each. A text longer than a
block is a block of its own. An empty table gives an empty one. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.session import durable

DEPTH = 3
BLOCK = 8 << 20  # bytes of text
SHARE = 10 << 20  # bytes of text whose windows a task holds, on average
HOT = 1 << 19  # occurrences
END = b"\n"
DISCOUNT = 0.75
STEP = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier that scatters numbers
PIECES = "block long, part long, blob binary"


def tokens(text: str) -> list[bytes]:
    """The words; bytes.lower and bytes.split know ASCII letters and white space only."""
    return text.encode().lower().split()


class Numbers(dict):
    """Symbols numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Chunk:
    """The symbols of some texts: their numbers in order, and the place of each in its text."""

    def __init__(self):
        self.numbers, self.parts, self.size = Numbers(), [], 0

    def add(self, text: str) -> None:
        words = tokens(text)
        words.append(END)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def arrays(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The different symbols, and the numbers and places of all."""
        sizes = np.array([len(p) for p in self.parts], np.int64)
        place = (np.arange(self.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        return list(self.numbers), np.concatenate(self.parts or [np.zeros(0, np.int32)]), place


def hashes_of(names: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in names], np.uint64)


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as planes of their bytes, compressed where that is shorter, no more planes than the largest number needs."""
    parts = []
    for column in columns:
        values = np.ascontiguousarray(column).astype("<u8")
        planes = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
        raw = values.view(np.uint8).reshape(-1, 8)
        bodies = [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(planes)]
        bodies = [min(body, pa.compress(body, codec="zstd", asbytes=True), key=len) for body in bodies]
        parts += [struct.pack(f"<IB{planes}I", len(values), planes, *map(len, bodies)), *bodies]
    return b"".join(parts)


def unpacked(blob: bytes) -> list[np.ndarray]:
    """The columns as signed numbers; those of 2^63 and more come back below zero."""
    at, columns = 0, []
    while at < len(blob):
        size, planes = struct.unpack_from("<IB", blob, at)
        lengths = struct.unpack_from(f"<{planes}I", blob, at + 5)
        at += 5 + 4 * planes
        raw = np.zeros((size, 8), np.uint8)
        for k, length in enumerate(lengths):
            body = blob[at:at + length]
            raw[:, k] = np.frombuffer(body if length == size else pa.decompress(body, size, codec="zstd"), np.uint8)
            at += length
        columns.append(raw.view("<u8").reshape(-1).view("<i8"))
    return columns


def starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the sorted keys begins."""
    flags = np.ones(len(sorted_keys[0]), bool)
    flags[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return flags


def steps(values: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Differences of values that rise inside groups; ``fresh`` flags a group's first, which stays."""
    out = values.copy()
    out[1:] -= np.where(fresh[1:], 0, values[:-1])
    return out


def summed(differences: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The values that ``steps`` made differences of."""
    if not len(differences):
        return differences
    total, first = np.cumsum(differences), np.flatnonzero(fresh)
    return total - np.repeat(total[first] - differences[first], np.diff(np.append(first, len(total))))


def scattered(numbers: np.ndarray) -> np.ndarray:
    return ((numbers.astype(np.uint64) * STEP) >> np.uint64(33)).astype(np.int64)


def pieces_of(group: pa.Table) -> list[tuple[int, int, bytes]]:
    return sorted(zip(group["block"].to_pylist(), group["part"].to_pylist(), group["blob"].to_pylist()), key=lambda p: p[:2])


def as_pieces(rows: list[tuple], first: str = "block", second: str = "part") -> pa.Table:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.table({first: pa.array(columns[0], pa.int64()), second: pa.array(columns[1], pa.int64()), "blob": pa.array(columns[2], pa.binary())})


def stored(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def reread(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def blocks_of(rows: DataFrame, limit: int) -> DataFrame:
    """Texts as symbols: block, words (hashes in order, training counts), blob, ends (rows that are learned from) and bytes of text.

    The blob holds doc_id, held_out and n_tokens of the rows and their symbols in order: 0
    for an end, else the word's place among the block's hashes, from 1.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, ids, held, size = Chunk(), [], [], 0
        number = TaskContext.get().partitionId() << 33

        def handed(kind: pa.DataType) -> pa.RecordBatch:
            names, symbols, _ = chunk.arrays()
            sizes = np.array([len(p) for p in chunk.parts])
            words = np.delete(np.arange(len(names)), chunk.numbers[END])
            hashes = hashes_of(names)[words]
            order = np.argsort(hashes)
            local = np.zeros(len(names), np.int32)
            local[words[order]] = np.arange(1, len(words) + 1)
            symbols = local[symbols]
            n = np.bincount(symbols[~np.repeat(np.array(held, bool), sizes)], minlength=len(names))[1:]
            docs = stored(pa.table({"doc_id": pa.array(ids, kind), "held_out": pa.array(held, pa.bool_()), "n_tokens": pa.array(sizes, pa.int64())}))
            hashes = hashes[order]
            return pa.RecordBatch.from_pylist([{
                "block": number, "words": packed(steps(hashes, np.arange(len(hashes)) == 0), n),
                "blob": struct.pack("<Q", len(docs)) + docs + packed(symbols), "ends": held.count(False), "bytes": size}], ROW)

        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, out, text in zip(*(batch.column(c) for c in ("doc_id", "held_out", "text"))):
                length = text.as_buffer().size
                if size and size + length > limit:
                    yield handed(kind)
                    chunk, ids, held, size, number = Chunk(), [], [], 0, number + 1
                chunk.add(text.as_py())
                ids.append(doc_id.as_py())
                held.append(out.as_py())
                size += length
        if ids:
            yield handed(kind)

    return rows.mapInArrow(cut, "block long, words binary, blob binary, ends long, bytes long")


ROW = pa.schema([("block", pa.int64()), ("words", pa.binary()), ("blob", pa.binary()), ("ends", pa.int64()), ("bytes", pa.int64())])


class Symbols:
    """The symbols of a block by local number, the numbers and training counts of its words, and where each symbol stands."""

    def __init__(self, blob: bytes, answers: list[bytes], n_ends: int):
        docs = struct.unpack_from("<Q", blob)[0] + 8
        self.rows = reread(blob[8:docs])
        self.local = unpacked(blob[docs:])[0].astype(np.int32)
        parts = [unpacked(a) for a in answers]
        self.number, self.n = (np.concatenate([np.array([end]), *(p[k] for p in parts)]) for k, end in enumerate((0, n_ends)))
        if self.local.max() >= len(self.n):
            raise RuntimeError("the answers are not those of this block's words")
        sizes = self.rows["n_tokens"].to_numpy()
        self.first = np.cumsum(sizes) - sizes
        self.place = (np.arange(len(self.local)) - np.repeat(self.first, sizes)).astype(np.int32)
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.learned = ~np.array(self.rows["held_out"].to_pylist(), bool)[self.doc]

    def before(self, distance: int) -> np.ndarray:
        """Local number of the word so far before each symbol, the end's if there is none."""
        found = np.zeros(len(self.local), np.int32)
        at = np.flatnonzero(self.place >= distance)
        found[at] = self.local[at - distance]
        return found


def asked(ranges: int):
    """A block's words, by ranges of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words in zip(batch.column("block").to_pylist(), batch.column("words")):
                differences, n = unpacked(words.as_py())
                hashes = np.cumsum(differences.view(np.uint64))
                cuts = np.searchsorted((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1))
                rows = [(block, r, packed(steps(hashes[a:b], np.arange(b - a) == 0), n[a:b])) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                yield from as_pieces(rows).to_batches()

    return run


def numbering(ranges: int):
    """Numbers and training counts of a range's words, frequent words first, for each block that asked; and one row of totals."""

    def run(group: pa.Table) -> pa.Table:
        pieces = pieces_of(group)
        own, lists = pieces[0][1], [unpacked(p[2]) for p in pieces]
        lists = [(np.cumsum(h.view(np.uint64)), n) for h, n in lists]
        words, slot = np.unique(np.concatenate([h for h, _ in lists]), return_inverse=True)
        n = np.bincount(slot, np.concatenate([n for _, n in lists]), len(words)).astype(np.int64)
        number = np.empty(len(words), np.int64)
        number[np.argsort(-n, kind="stable")] = np.arange(len(words)) * ranges + own + 1
        parts = np.split(slot, np.cumsum([len(h) for h, _ in lists])[:-1])
        table = as_pieces([(block, own, packed(number[p], n[p])) for (block, *_), p in zip(pieces, parts)] + [(-1, own, b"")])
        none = [0] * len(pieces)
        return table.append_column("n", pa.array([*none, int(n.sum())], pa.int64())).append_column("kinds", pa.array([*none, int((n > 0).sum())], pa.int64()))

    return run


def opened(group: pa.Table, n_ends: int) -> tuple[int, Symbols]:
    """The block of a group of its symbols (part -1) and the answers to its words."""
    pieces = pieces_of(group)
    return pieces[0][0], Symbols(pieces[0][2], [p[2] for p in pieces[1:]], n_ends)


def splits(n: np.ndarray, hot: int) -> np.ndarray:
    """How many tasks share the branch of a word with n occurrences."""
    return np.maximum(1, -(-n // hot))


def windows(shards: int, hot: int, n_ends: int, mass: float):
    """shard, block, blob: a block's different windows, and (shard below 0) what its documents need besides."""

    def run(group: pa.Table) -> pa.Table:
        block, s = opened(group, n_ends)
        base = np.log10((s.n + 0.1) / mass)[s.local]
        docs = pa.table({
            "doc_id": s.rows["doc_id"], "held_out": s.rows["held_out"], "n_tokens": s.rows["n_tokens"],
            "n_known": np.add.reduceat((s.n[s.local] > 0).astype(np.int64), s.first), "base_score": np.add.reduceat(base, s.first), "first": base[s.first]})
        rows = [(-1 - block, block, stored(docs))]
        by_number = np.argsort(s.number)
        rank = np.empty(len(by_number), np.uint32)
        rank[by_number] = np.arange(len(by_number))  # the end, and no word, come first
        later, shift = np.flatnonzero(s.place > 0), np.uint64(32)
        high, low = (rank[x[later]].astype(np.uint64) << shift | rank[y[later]] for x, y in ((s.before(1), s.before(2)), (s.before(3), s.local)))
        order = np.lexsort((low, high))
        high, low, at = high[order], low[order], later[order]
        first = np.flatnonzero(starts(high, low)) if len(at) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(at)))
        n = np.add.reduceat(s.learned[at].astype(np.int64), first) if len(at) else times
        c, b, a, w = (by_number[x.astype(np.int64)] for x in (high[first] >> shift, high[first].astype(np.uint32), low[first] >> shift, low[first].astype(np.uint32)))
        shard = (scattered(s.number[c]) + scattered(s.number[b] + 1) % splits(s.n[c], hot)) % shards
        kept = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[kept], np.arange(shards + 1))
        for k in np.flatnonzero(np.diff(cuts)):
            p = kept[cuts[k]:cuts[k + 1]]
            wide = [s.number[x[p]] for x in (c, b, a, w)]
            which, there = np.unique(wide[3], return_index=True)
            docs_at = np.repeat(first[p] - np.cumsum(times[p]) + times[p], times[p]) + np.arange(times[p].sum())
            rows.append((int(k), block, packed(
                steps(wide[0], np.arange(len(p)) == 0), steps(wide[1], starts(wide[0])), steps(wide[2], starts(*wide[:2])), wide[3],
                n[p], times[p], s.doc[at[docs_at]], s.n[w[p]][there])))
        return as_pieces(rows, "shard", "block")

    return run


def hot_pairs(hot: int, n_ends: int, parts: int):
    """word, part, blob: next symbols of the words whose branches are dealt to several tasks."""

    def run(group: pa.Table) -> pa.Table:
        _, s = opened(group, n_ends)
        before = s.before(1)
        at = np.flatnonzero((s.place > 0) & s.learned & (splits(s.n, hot) > 1)[before])
        keys, n = np.unique(before[at].astype(np.int64) * len(s.n) + s.local[at], return_counts=True)
        word, next_ = keys // len(s.n), keys % len(s.n)
        pairs = np.stack([s.number[word], s.number[next_] % parts, s.number[next_], s.n[next_], n])
        pairs = pairs[:, np.lexsort(pairs[2::-1])]
        n = pairs[4]
        first = np.append(np.flatnonzero(starts(pairs[0], pairs[1])), len(n)) if len(n) else [0]
        return as_pieces([(int(pairs[0][i]), int(pairs[1][i]), packed(steps(pairs[2][i:j], np.arange(j - i) == 0), n[i:j], pairs[3][i:j]))
                          for i, j in zip(first, first[1:])], "word", "part")

    return run


def pair_sums(group: pa.Table) -> pa.Table:
    """The next symbols of one word and part (``part``) or of all parts, summed over blocks; alike for one row and many."""
    lists = [unpacked(x) for x in group["blob"].to_pylist()]
    words, there, slot = np.unique(np.concatenate([np.cumsum(x[0]) for x in lists]), return_index=True, return_inverse=True)
    n = np.bincount(slot, np.concatenate([x[1] for x in lists])).astype(np.int64)
    blob = packed(steps(words, np.arange(len(words)) == 0), n, np.concatenate([x[2] for x in lists])[there])
    return as_pieces([(group["word"][0].as_py(), group["part"][0].as_py(), blob)], "word", "part")


def judged(context: np.ndarray, n: np.ndarray, p: np.ndarray, total: np.ndarray, gain: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether each context is retained, and the weight of its suffix; rows: counted runs with n and P of the suffix."""
    size = len(total)
    known, kinds = np.bincount(context, n, size), np.bincount(context, minlength=size)
    of = np.maximum(total, 1)
    left = 1 - (known - DISCOUNT * kinds) / of
    gained = np.bincount(context, n * np.log(((n - DISCOUNT) / of[context] + left[context] * p) / p), size)
    gained = gained + (total - known) * np.log(np.maximum(left, 1e-9))
    return (kinds > 0) & (gained >= gain), left


def headed(shards: int, hot: int, mass: float, least: int, gain: float):
    """shard, block (-1), blob: a hot word's number, occurrences, whether it is retained as a context, and its counted next symbols."""

    def run(group: pa.Table) -> pa.Table:
        word = group["word"][0].as_py()
        words, n, of = unpacked(pair_sums(group)["blob"][0].as_py())
        words, total, often = np.cumsum(words), int(n.sum()), n >= least
        words, n, p = words[often], n[often], (of[often] + 0.1) / mass
        kept, _ = judged(np.zeros(len(n), np.int64), n, p, np.array([total]), gain)
        blob = packed(np.array([word, total, int(kept[0])]), steps(words, np.arange(len(words)) == 0), n)
        own = scattered(np.array([word]))[0] + np.arange(splits(np.array([total]), hot)[0])
        return as_pieces([(int(k), -1, blob) for k in np.unique(own % shards)], "shard", "block")

    return run


def grown(mass: float, least: int, gain: float):
    """block, part (shard), blob: the sums of log10 P of a block's documents over the branches of a task."""

    def run(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        if shard < 0:
            return as_pieces([(b, -1, blob) for b, blob in zip(group["block"].to_pylist(), group["blob"].to_pylist())])
        rows = sorted(zip(group["block"].to_pylist(), group["blob"].to_pylist()), key=lambda r: r[0])
        heads = [unpacked(blob) for block, blob in rows if block < 0]
        blocks, lists = [block for block, _ in rows if block >= 0], [unpacked(blob) for block, blob in rows if block >= 0]
        if not lists:
            return as_pieces([])
        for x in lists:
            x[0] = np.cumsum(x[0])
            x[1] = summed(x[1], starts(x[0]))
            x[2] = summed(x[2], starts(x[0], x[1]))
        words, there = np.unique(np.concatenate([np.unique(x[3]) for x in lists]), return_index=True)
        root = (np.concatenate([x[7] for x in lists])[there] + 0.1) / mass
        c, b, a, w, n = (np.concatenate([x[k] for x in lists]) for k in range(5))
        w = np.searchsorted(words, w)
        order = np.lexsort((a << 32 | w, c << 32 | b) if max(x.max() for x in (c, b, a, w)) < 1 << 31 else (w, a, b, c))
        c, b, a, w = c[order], b[order], a[order], w[order]
        fresh = starts(c, b, a, w)
        slot = np.empty(len(order), np.int64)
        slot[order] = np.cumsum(fresh) - 1
        n = np.bincount(slot, n)
        c, b, a, w = c[fresh], b[fresh], a[fresh], w[fresh]
        p = root[w]
        for size, (keys, fits) in enumerate([((c,), np.ones(len(c), bool)), ((c, b), b > 0), ((c, b, a), a > 0)], 1):
            context = np.cumsum(starts(*keys)) - 1
            own = np.where(fits, n, 0.0)
            at = run_of = np.arange(len(c))  # the longest runs are the windows themselves
            if size < DEPTH:
                _, at, run_of = np.unique(context * len(words) + w, return_index=True, return_inverse=True)
            times, of = np.bincount(run_of, own), context[at]
            total = np.bincount(context, own)
            often = times >= least
            kept, left = judged(of[often], times[often], p[at][often], total, gain)
            for (word, every, holds), next_, counts in heads if size == 1 else ():
                next_ = np.cumsum(next_)
                k = np.searchsorted(c, word)
                if k < len(c) and c[k] == word:
                    k = context[k]
                    mine = np.flatnonzero(of == k)
                    place, found = lookup(next_, words[w[at[mine]]])
                    times[mine] = 0
                    times[mine[found]] = counts[place[found]]
                    total[k], kept[k], left[k] = every, bool(holds), 1 - (counts.sum() - DISCOUNT * len(counts)) / every
            adds = np.where(times >= least, (times - DISCOUNT) / np.maximum(total[of], 1), 0.0)
            p = np.where(kept[context], p * left[context] + adds[run_of], p)
        logs = np.log10(p)[slot]
        ends = np.cumsum([len(x[0]) for x in lists])
        out = []
        for block, x, end in zip(blocks, lists, ends):
            sums = np.bincount(x[6], np.repeat(logs[end - len(x[0]):end], x[5]))
            docs = np.unique(x[6])
            out.append((block, shard, packed(steps(docs, np.arange(len(docs)) == 0), sums[docs].astype("<f4").view("<u4"))))
        return as_pieces(out)

    return run


def lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the keys in the sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    slot = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return slot, table[slot] == keys


def finished(total: int):
    """The result rows of a block from its documents (part -1) and their sums by task."""

    def run(group: pa.Table) -> pa.Table:
        pieces = pieces_of(group)
        docs = reread(pieces[0][2])
        score = docs["first"].to_numpy().copy()
        for _, _, blob in pieces[1:]:
            at, sums = unpacked(blob)
            score[np.cumsum(at)] += sums.astype("<u4").view("<f4")
        return pa.table({
            "doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": docs["n_tokens"], "n_known": docs["n_known"],
            "train_tokens": pa.array(np.full(len(score), total, np.int64)), "base_score": docs["base_score"], "score": pa.array(score)})

    return run


def score(docs: DataFrame, held_out: Column, least: int = 2, gain: float = 4.0, hot: int = HOT, share: int = SHARE, block: int = BLOCK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; documents held out aren't learned from.

    ``block``: bytes of text in a block; ``share``: bytes of text whose windows a task holds on average; ``hot``: occurrences of a word beyond which its branch is dealt to several tasks.
    """
    rows = docs.select("doc_id", held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    blocks = durable(blocks_of(rows, block))
    n_blocks, n_ends, size = blocks.agg(F.count("*"), F.coalesce(F.sum("ends"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    ranges, shards = max(1, n_blocks // 2), max(1, -(-size // share))
    named = blocks.select("block", "words").mapInArrow(asked(ranges), PIECES)
    numbers = durable(named.groupBy("part").applyInArrow(numbering(ranges), PIECES + ", n long, kinds long"))
    n_words, distinct = numbers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    total, kinds = n_words + n_ends, distinct + (n_ends > 0)
    mass = total + 0.1 * (kinds + 1)
    whole = blocks.select("block", F.lit(-1).cast("long").alias("part"), "blob").union(numbers.where("block >= 0").select("block", "part", "blob")).groupBy("block")
    sent = whole.applyInArrow(windows(shards, hot, n_ends, mass), "shard long, block long, blob binary")
    pairs = whole.applyInArrow(hot_pairs(hot, n_ends, max(1, n_blocks // 8)), "word long, part long, blob binary")
    once = pairs.groupBy("word", "part").applyInArrow(pair_sums, "word long, part long, blob binary")
    heads = once.groupBy("word").applyInArrow(headed(shards, hot, mass, least, gain), "shard long, block long, blob binary")
    sums = sent.union(heads).groupBy("shard").applyInArrow(grown(mass, least, gain), PIECES)
    return sums.groupBy("block").applyInArrow(
        finished(total), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
