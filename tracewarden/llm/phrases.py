"""Phrase collocations, counted by a multikey three-way quicksort of suffix pointers.

A suffix is what follows a word of a piece, at most as many words as a phrase may have. The leading words are counted globally: first
words, then pairs of frequent words, then, by tables of counters, chains of three words and more that frequent pairs link. Suffixes that
don't begin with three such words are abandoned there, and a suffix ends where the next word would make a chain in it infrequent, since
a phrase is never more frequent than its parts. The others are routed by their leading pair, or by one more word for as long as that prefix is hot, so a group of any size
is split. Inside a task, pointers to the suffixes of complete groups are parted by their word at one depth into smaller, equal and
larger; the weight of the equal part is the count of its phrase, and parts below the least count are abandoned with all that is in them.

What tasks know of frequent words, pairs and chains is one bit of a table of fixed size each: what is let through by mistake costs
time and is counted exactly later.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracewarden.llm.words import texts
from tracewarden.plans.skew import MAX_HOT, split_join
from tracewarden.session import written_table

#: Ids that a task gathers before it counts them, and bytes of words that it knows by number.
BUFFER = 4 << 20
VOCABULARY_BYTES = 48 << 20
#: Bits of the tables of frequent words and pairs: 2 MB each, whatever the data.
BITS = 24
#: Counters for chains of one size, as a power of two, and the counters in a row; a task sends a byte for each, or four for large least counts.
SKETCH, SKETCH_ROW = 22, 1 << 12
#: Rows that a task gathers from complete groups before it sorts them.
GROUP_ROWS = 1 << 19
#: A prefix that leads more suffixes than this is routed by one more word.
HOT = 1_000_000
#: Lower case for A-Z, a space for the other space inside pieces, a line end for what ends pieces.
_PLAIN = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\x09" + bytes(range(65, 91)), b"\n" * 9 + b" " + bytes(range(97, 123)))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of each piece of a text."""
    return map(bytes.split, text.translate(_PLAIN).split(b"\n"))


class _Ids(dict):
    def __init__(self, vocabulary: Vocabulary, lang: str):
        self.vocabulary, self.lead = vocabulary, f"{lang}\n".encode()
        self.lang = len(vocabulary.langs)
        vocabulary.langs.append(lang)

    def __missing__(self, word: bytes) -> int:
        v = self.vocabulary
        v.size += len(word) + 100
        h = xxhash.xxh64_intdigest(self.lead + word)
        n = 0
        at = h >> 64 - BITS
        if v.bits is None or v.bits[at >> 3] >> (at & 7) & 1:
            n = len(v.words)
            v.words.append(word)
            v.hashes.append(h)
            v.lang_of.append(self.lang)
        self[word] = n
        return n


class Vocabulary:
    """Numbers from 1 for the words of each language that a table of ``bits`` lets through; 0 for others."""

    def __init__(self, bits: bytes | None = None):
        self.bits, self.size = bits, 0
        self.langs: list[str] = []
        self.words, self.hashes, self.lang_of = [b""], array("Q", [0]), array("I", [0])
        self._by_lang: dict[str, _Ids] = {}

    def of(self, lang: str) -> _Ids:
        if lang not in self._by_lang:
            self.size += len(lang) + 300
            self._by_lang[lang] = _Ids(self, lang)
        return self._by_lang[lang]

    def columns(self, first: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """All words, the languages of the words numbered ``first``, and the hashes of all words."""
        words = pa.array(self.words, pa.binary()).cast(pa.string())
        langs = pa.array(self.langs, pa.string()).take(pa.array(np.frombuffer(self.lang_of, np.uint32)[first]))
        return words, langs, np.frombuffer(self.hashes, np.uint64)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * _A + b) * _B


def _has(bits: bytes, hashes: np.ndarray, size: int = BITS) -> np.ndarray:
    at = hashes >> np.uint64(64 - size)
    return np.frombuffer(bits, np.uint8)[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


def _scanned(docs: DataFrame, bits: bytes | None, schema: str, start: Callable) -> DataFrame:
    """What is made of the word numbers of pieces, each piece followed by a 0: ``start()`` gives a task its two functions, one from a
    vocabulary and word numbers to rows or None, and one for the rows at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, ids, (emit, finish) = Vocabulary(bits), array("I", [0]), start()
        for batch in batches:
            for text, lang in zip(texts(batch), batch.column(1).to_pylist()):
                if not text:
                    continue
                get = vocabulary.of(lang).__getitem__
                for words in pieces(text):
                    ids.extend(map(get, words))
                    ids.append(0)
                full = vocabulary.size >= VOCABULARY_BYTES
                if full or len(ids) >= BUFFER:
                    yield from _sliced(emit(vocabulary, np.frombuffer(ids, np.uint32)))
                    ids = array("I", [0])
                    if full:
                        vocabulary = Vocabulary(bits)
        yield from _sliced(emit(vocabulary, np.frombuffer(ids, np.uint32)))
        yield from _sliced(finish())

    return docs.mapInArrow(run, schema)


def _nothing() -> None:
    return None


def _sliced(batch: pa.RecordBatch | None, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows if batch else 0, rows):
        yield batch.slice(at, rows)


def _words(vocabulary: Vocabulary, ids: np.ndarray) -> pa.RecordBatch:
    """Occurrences of each word, and of all words of a language as those of a null phrase."""
    n = np.bincount(ids, minlength=len(vocabulary.words))
    n[0] = 0
    some = np.flatnonzero(n)
    words, langs, _ = vocabulary.columns(some)
    totals = np.bincount(np.frombuffer(vocabulary.lang_of, np.uint32)[some], n[some], len(vocabulary.langs)).astype(np.int64)
    return pa.RecordBatch.from_arrays([
        pa.concat_arrays([langs, pa.array(vocabulary.langs, pa.string())]),
        pa.concat_arrays([words.take(pa.array(some)), pa.nulls(len(totals), pa.string())]),
        pa.array(np.concatenate([n[some], totals]))], ["lang", "phrase", "f"])


def _pairs(vocabulary: Vocabulary, ids: np.ndarray) -> pa.RecordBatch:
    left, right = ids[:-1], ids[1:]
    both = np.flatnonzero((left > 0) & (right > 0))
    codes, n = np.unique(left[both].astype(np.uint64) << np.uint64(32) | right[both], return_counts=True)
    left, right = (codes >> np.uint64(32)).astype(np.int64), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64)
    words, langs, _ = vocabulary.columns(left)
    phrases = pc.binary_join_element_wise(words.take(pa.array(left)), words.take(pa.array(right)), " ")
    return pa.RecordBatch.from_arrays([langs, phrases, pa.array(n)], ["lang", "phrase", "f"])


def _chains(vocabulary: Vocabulary, ids: np.ndarray, pair_bits: bytes, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 3 words and more, up to ``longest``: where so many words begin that are linked by frequent pairs, and their hashes."""
    hashes = np.frombuffer(vocabulary.hashes, np.uint64)
    left, right = ids[:-1], ids[1:]
    link = np.zeros(len(ids) + longest, dtype=bool)
    both = np.flatnonzero((left > 0) & (right > 0))
    pair = _pair_hash(hashes[left[both]], hashes[right[both]])
    keep = _has(pair_bits, pair)
    starts, found = both[keep], pair[keep]
    link[starts] = True
    for size in range(3, longest + 1):
        more = link[starts + size - 2]
        starts = starts[more]
        found = _pair_hash(found[more], hashes[ids[starts + size - 1]])
        yield starts, found


def _chain_bits(docs: DataFrame, word_bits: bytes, pair_bits: bytes, least: int, longest: int) -> list[bytes]:
    """For chains of 3 words up to ``longest``, a bit for each counter that reaches ``least``. A counter is the sum of those of the tasks,
    which stop at ``least``."""
    kind, sizes = np.uint8 if least < 256 else np.uint32, max(0, longest - 2)

    def start():
        counters = np.zeros((sizes, 1 << SKETCH), dtype=np.int32)

        def emit(vocabulary: Vocabulary, ids: np.ndarray) -> None:
            for row, (_, hashes) in zip(counters, _chains(vocabulary, ids, pair_bits, longest)):
                np.add(row, np.bincount((hashes >> np.uint64(64 - SKETCH)).astype(np.int64), minlength=len(row)), out=row, casting="unsafe")

        def finish() -> pa.RecordBatch:
            rows = np.minimum(counters, least).astype(kind).reshape(-1, SKETCH_ROW)
            some = np.flatnonzero(rows.any(axis=1))
            return pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array([rows[i].tobytes() for i in some.tolist()], pa.binary())], ["row", "counters"])

        return emit, finish

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, counters in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(counters.as_py(), kind)
                sums[row] = np.minimum(sums.get(row, 0) + found.astype(np.int64), least)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()),
             pa.array([np.packbits(c >= least, bitorder="little").tobytes() for c in sums.values()], pa.binary())], ["row", "bits"])

    rows = _scanned(docs, word_bits, "row bigint, counters binary", start)
    size = SKETCH_ROW // 8
    tables = [bytearray((1 << SKETCH) // 8) for _ in range(sizes)]
    # A bit for each counter reaches the driver.
    for row in rows.repartition("row").mapInArrow(total, "row bigint, bits binary").collect():
        table, at = divmod(row["row"], (1 << SKETCH) // SKETCH_ROW)
        tables[table][at * size:(at + 1) * size] = row["bits"]
    return [bytes(t) for t in tables]


def _suffixes(pair_bits: bytes, chain_bits: list[bytes], depth: int) -> Callable:
    """Distinct suffixes of at least three words without an infrequent chain in them, with their number."""
    def emit(vocabulary: Vocabulary, ids: np.ndarray) -> pa.RecordBatch:
        frequent = []
        for bits, (at, hashes) in zip(chain_bits, _chains(vocabulary, ids, pair_bits, len(chain_bits) + 2)):
            frequent.append(np.zeros(len(ids) + depth, dtype=bool))
            frequent[-1][at[_has(bits, hashes, SKETCH)]] = True
        starts = np.flatnonzero(frequent[0])
        padded = np.concatenate([ids, np.zeros(depth, np.uint32)]).astype(np.int64)
        columns, linked = [padded[starts + d] for d in range(3)], np.ones(len(starts), dtype=bool)
        for d in range(3, depth):
            for size, known in enumerate(frequent, 3):
                if d >= size - 1:
                    linked = linked & known[starts + d - size + 1]
            columns.append(np.where(linked, padded[starts + d], 0))
        # Exact numbers of equal suffixes, one word after the other.
        code, first, n = columns[0], np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for column in columns[1:] if len(starts) else ():
            _, first, code, n = np.unique(code << 32 | column, return_index=True, return_inverse=True, return_counts=True)
        table = np.stack([c[first] for c in columns], axis=1)
        words, langs, _ = vocabulary.columns(table[:, 0])
        size = (table > 0).sum(axis=1)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), words.take(pa.array(table[table > 0])))
        return pa.RecordBatch.from_arrays([langs, lists, pa.array(n)], ["lang", "words", "f"])

    return lambda: (emit, _nothing)


def _bit_table(frequent: DataFrame, pair: bool) -> bytes:
    """Bits of the words or pairs ``lang, phrase``, as one table of fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            hashes = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes.append([xxhash.xxh64_intdigest(f"{lang}\n{w}".encode()) for w in phrase.split(" ")])
            h = np.array(hashes, dtype=np.uint64).reshape(len(hashes), -1)
            found = _pair_hash(h[:, 0], h[:, 1]) if pair else h[:, 0]
            bits[found >> np.uint64(64 - BITS)] = True
        packed = np.packbits(bits, bitorder="little").view("<i8")
        some = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(packed[some])], ["slot", "bits"])

    rows = frequent.select("lang", "phrase").mapInArrow(run, "slot bigint, bits bigint")
    found = rows.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << BITS - 6, dtype="<i8")
    table[found.column("slot").to_numpy()] = found.column("bits").to_numpy()
    return table.tobytes()


def _sorted_counts(table: pa.Table, depth: int, least: int) -> tuple[pa.Table, np.ndarray]:
    """Counts of the phrases of complete groups ``lang, routed, words, f``: the rows of a representative of each, with
    ``size`` and ``n``, where the size is 3 at least and not below the depth the group is routed by."""
    lists = table.column("words").combine_chunks()
    flat = lists.flatten().dictionary_encode()
    number = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    keys = np.zeros((depth + 1, len(sizes)), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    keys[1 + np.arange(len(number)) - starts[row], row] = number
    keys[0] = table.column("lang").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) + 1
    weight, routed = table.column("f").to_numpy(), table.column("routed").to_numpy()
    found = []
    parts = [(np.arange(len(sizes)), 0)]
    while parts:
        pointers, d = parts.pop()
        key = keys[d, pointers]
        pivot = key[len(key) // 2]
        for side in (key < pivot, key > pivot, key == pivot):
            part = pointers[side]
            total = int(weight[part].sum())
            if total < least:
                continue
            if side[len(key) // 2]:
                if not pivot:
                    continue
                if d >= max(3, routed[part[0]]):
                    found.append((part[0], d, total))
                if d < depth:
                    parts.append((part, d + 1))
            else:
                parts.append((part, d))
    at = np.array(found, dtype=np.int64).reshape(-1, 3)
    return table.take(pa.array(at[:, 0])), at[:, 1:]


def _count_groups(depth: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(table: pa.Table) -> Iterator[pa.RecordBatch]:
            rows, found = _sorted_counts(table, depth, least)
            words = [w[:size] for w, size in zip(rows.column("words").to_pylist(), found[:, 0])]
            batch = pa.RecordBatch.from_arrays([
                rows.column("lang").combine_chunks(), pa.array([" ".join(w) for w in words], pa.string()),
                pa.array(found[:, 1])], ["lang", "phrase", "f"])
            yield from _sliced(batch)

        waiting, rows, tried = [], 0, GROUP_ROWS
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows < tried:
                continue
            # The last group may go on in the next batch.
            table = pa.Table.from_batches(waiting)
            last = [pc.equal(table.column(c), table.column(c)[-1]) for c in ("lang", "key")]
            begin = pc.index(pc.and_(*last), pa.scalar(True)).as_py()
            if begin:
                yield from counted(table.slice(0, begin))
            waiting, rows = table.slice(begin).to_batches(), len(table) - begin
            tried = rows + GROUP_ROWS
        if rows:
            yield from counted(pa.Table.from_batches(waiting))

    return run


def _prefix(depth: int | Column) -> Column:
    return F.array_join(F.slice("words", 1, depth), " ")


def _routed(suffixes: DataFrame, pairs: DataFrame, total: int, depth: int, least: int, hot: int) -> tuple[DataFrame, list[DataFrame]]:
    """Suffixes with ``routed``, the number of leading words that deal them, and the counts of hot prefixes beyond pairs."""
    limit = max(hot, least - 1, total // MAX_HOT)
    rows = suffixes.withColumn("routed", F.lit(2))
    heavy, known = pairs.filter(F.col("f") > limit).select("lang", "phrase"), []
    if not heavy.isEmpty():
        rows = written_table(rows, "phrase-suffixes")
    for d in range(2, depth):
        if heavy.isEmpty():
            break
        # At most MAX_HOT prefixes are longer than total / MAX_HOT.
        marked = F.broadcast(heavy.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.lit(True).alias("_hot")))
        rows = rows.join(marked, (F.col("lang") == F.col("_lang")) & (_prefix(d) == F.col("_phrase")) & (F.col("routed") == d), "left")
        # A suffix that ends with its hot prefix was counted with it.
        rows = rows.filter(F.col("_hot").isNull() | (F.size("words") > d)).withColumn(
            "routed", F.when(F.col("_hot"), d + 1).otherwise(F.col("routed"))).drop("_lang", "_phrase", "_hot")
        counts = rows.filter(F.col("routed") == d + 1).groupBy("lang", _prefix(d + 1).alias("phrase")).agg(F.sum("f").alias("f"))
        heavy = written_table(counts.filter(F.col("f") > limit), "phrase-hot")
        known.append(heavy)
        heavy = heavy.select("lang", "phrase")
    return rows, known


def phrase_counts(docs: DataFrame, least: int = 100, longest: int = 5, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, f`` of all phrases of 1 to ``longest`` (at least 4) words with ``least`` occurrences or more, and ``lang, n``, the
    number of all words. Both are stored tables."""
    docs = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    plain = "lang string, phrase string, f bigint"
    summed = lambda rows: rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    words = written_table(summed(_scanned(docs, None, plain, lambda: (_words, _nothing))).filter(
        F.col("phrase").isNull() | (F.col("f") >= least)), "phrase-words")
    totals = words.filter(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    words = words.filter(F.col("phrase").isNotNull())
    word_bits = _bit_table(words, False)
    pairs = written_table(summed(_scanned(docs, word_bits, plain, lambda: (_pairs, _nothing))).filter(F.col("f") >= least), "phrase-pairs")
    pair_bits = _bit_table(pairs, True)
    suffixes = _scanned(docs, word_bits, "lang string, words array<string>, f bigint",
                        _suffixes(pair_bits, _chain_bits(docs, word_bits, pair_bits, least, longest - 1), longest))
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    rows, known = _routed(suffixes, pairs, total, longest, least, hot)
    keyed = rows.select("lang", _prefix(F.col("routed")).alias("key"), "routed", "words", "f")
    longer = keyed.repartition("lang", "key").sortWithinPartitions("lang", "key").mapInArrow(_count_groups(longest, least), plain)
    counts = words.unionByName(pairs).unionByName(longer)
    for prefixes in known:
        counts = counts.unionByName(prefixes)
    size = F.size(F.split("phrase", " "))
    return written_table(counts.select("lang", "phrase", size.alias("size"), "f"), "phrase-counts"), totals


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, keep: int = 2000, share: int = 100,
                 hot: int = HOT) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``keep`` phrases of each language.

    ``docs`` has ``text`` and ``lang``; other columns aren't read. Null and empty texts have no words, a null language is
    ``und``, repeated rows count each time, and an empty table gives no rows. A piece is held whole by a task, and so are the
    suffixes of one group. A phrase of 2 words and more is a candidate if it occurs ``least`` times (a); of its cuts into two parts (l and r
    times) the one with the lowest floor(1000 a n / (l r)) counts, of equal ones the first. Candidates
    inside a longer candidate with ``share`` percent of their occurrences are left out. Ties of the score go by a, then by the phrase's
    bytes. Products are decimals of 38 digits, and a larger one raises.
    """
    counts, totals = phrase_counts(docs, least, longest, hot)
    candidates = counts.filter(F.col("size") > 1)
    rows = candidates.count()
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).withColumn(
        "left", F.expr("substring_index(phrase, ' ', k)")).withColumn(
        "right", F.expr("substring(phrase, length(left) + 2)")).withColumnRenamed("f", "a")
    part = lambda side, f: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    cuts = split_join(cuts, part("left", "l"), ["lang", "left"], ["phrase", "k"], total=4 * rows)
    cuts = split_join(cuts, part("right", "r"), ["lang", "right"], ["phrase", "k"], total=4 * rows)
    cuts = split_join(cuts, totals, ["lang"], ["phrase", "k"], total=4 * rows)
    score = F.expr("(1000BD * cast(a as decimal(18,0)) * cast(n as decimal(18,0))) div "
                   "(cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr("""flatten(transform(sequence(2, size - 1), m ->
        transform(sequence(1, size - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' '))))""")
    inside = candidates.filter(F.col("size") > 2).select("lang", F.explode(inner).alias("phrase"), "f").groupBy(
        "lang", "phrase").agg(F.max("f").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("a")))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return left.select(
        "lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score",
    ).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
