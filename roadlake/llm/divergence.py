"""Source divergence audit over a vocabulary held in minimal acyclic transducers (operator 11).

Each language keeps the terms that occur in at least SUPPORT of its documents. The kept terms, sorted by language and bytes and
cut into ranges, are built into a minimal acyclic transducer for each range, word by word from the sorted list: states with
equal futures are one, and the outputs on a path add up to the term's lexicographic ordinal. Then the texts are
streamed through them: each task sorts the terms of its texts into streams by range, a range's streams meet its transducer, and
what it accepts is counted by ordinal. Ordinals break ties, and top ordinals are spelled by walking the transducer backwards from its counts.

Smoothed shares are whole numbers, exact at any size (decimals of 38 digits): p = 1 + SCALE * (count + 2) div (N + 2 V). The divergence of a
term is (p - q)^2 div (p + q). Sources of a language are compared with each other over all kept terms, in blocks of sources and of
ordinals; the pairs are the result asked for, texts and terms are not paired.

Null text, language and source are ''. Repeated rows count each. A language without kept terms has V = 0 and pairs of
value 0; a language with one source has none. Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlake.llm.common import slices, table, trim
from roadlake.session import materialize

SUPPORT = 10
SCALE = 1_000_000_000
TOP = 10
#: Bytes of terms: letters A to Z, a to z and all bytes of characters beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of texts that are cut into terms at once; different (language, source, term) a task holds before it passes them on.
LOT, HELD = 1 << 20, 1 << 20
#: Ordinals and sources that a task compares at once.
WIDTH, SOURCES = 1024, 256
#: Between language and term in a transducer; no byte of a text is this one.
BAR = b"\xff"


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of consecutive texts, and the number of the text that each is in."""
    inner = LETTER[data]
    new = inner.copy()
    new[1:] &= ~inner[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]  # a text begins a term, whatever was before
    new[edges] = inner[edges]
    starts = np.flatnonzero(new)
    ends = np.append(np.cumsum(inner)[starts[1:] - 1], inner.sum()) if len(starts) else np.zeros(0)
    letters = LOWER[data[inner]]
    borders = np.concatenate([[0], ends]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(letters)])
    return words, np.searchsorted(offsets, starts, "right") - 1


def tally(pieces: list[pa.Table], keys: list[str]) -> pa.Table:
    """Sums of n by the keys, which are dictionary codes; a task holds too few values for the product of their numbers to overflow."""
    whole = pa.concat_tables(pieces).unify_dictionaries().combine_chunks()
    code = np.zeros(len(whole), np.int64)
    for key in keys:
        column = whole[key].combine_chunks()
        code = code * max(len(column.dictionary), 1) + column.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    heads = np.flatnonzero(np.diff(code[order], prepend=-1))
    sums = np.add.reduceat(whole["n"].to_numpy()[order], heads) if len(heads) else np.zeros(0, np.int64)
    return whole.select(keys).take(pa.array(order[heads])).append_column("n", pa.array(sums))


def counted(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, keys: list[str], once: bool) -> pa.Table:
    """Counts of the terms of a few texts, by the other keys and term."""
    words, rows = terms_of(data, offsets)
    coded = words.dictionary_encode()
    codes, size = coded.indices.to_numpy().astype(np.int64), max(len(coded.dictionary), 1)
    if once:
        pairs = np.unique(rows * size + codes)
        rows, codes = pairs // size, pairs % size
    owner = np.zeros(len(part), np.int64)  # texts with equal keys have one owner
    for key in keys[:-1]:
        own = part.column(key).dictionary_encode()
        owner = owner * max(len(own.dictionary), 1) + own.indices.to_numpy()
    _, first, owner = np.unique(owner, return_index=True, return_inverse=True)
    pairs, n = np.unique(owner[rows] * size + codes, return_counts=True)
    held = part.take(pa.array(first[pairs // size]))
    term = pa.DictionaryArray.from_arrays(pa.array((pairs % size).astype(np.int32)), coded.dictionary)
    return pa.table({**{k: held.column(k).dictionary_encode() for k in keys[:-1]}, "term": term, "n": n})


def tallies(batches: Iterator[pa.RecordBatch], keys: list[str], once: bool) -> Iterator[pa.Table]:
    """Counts of terms by ``keys``, of which term is the last; with ``once`` a term counts once in each text."""
    held: list[pa.Table] = []
    size = limit = 0
    for batch in batches:
        names = batch.select(keys[:-1])
        for a, b, data, offsets in slices(batch.column("text"), LOT):
            held.append(counted(names.slice(a, b - a), data, offsets, keys, once))
            size += len(held[-1])
            if size > limit + HELD:
                held = [tally(held, keys)]
                size = limit = len(held[0])
                if size > HELD:
                    yield held[0]
                    held, size, limit = [], 0, 0
    if held:
        yield tally(held, keys)
    trim()


def vocabulary(docs: DataFrame, support: int) -> DataFrame:
    """(lang, term): the terms that each language keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tallies(batches, ["lang", "term"], once=True):
            names = part.select(["lang", "term"]).cast(pa.schema([("lang", pa.string()), ("term", pa.string())]))
            yield from names.append_column("n", part["n"]).to_batches()

    seen = docs.mapInArrow(run, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return seen.filter(F.col("n") >= support).select("lang", "term")


class Builder:
    """A minimal acyclic transducer from sorted strings: a state is registered when no later string can change it, and one with the
    same arcs and finality is used instead. Arcs are kept as numbers state * 256 + byte, sorted."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.sizes: list[int] = []
        self.path: list[list] = [[False, []]]  # unfinished states: finality, arcs [byte, target]
        self.last = b""

    def _freeze(self, node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in self.known:
            self.known[key] = len(self.states)
            self.states.append(key)
            self.sizes.append(node[0] + sum(self.sizes[target] for _, target in node[1]))
        return self.known[key]

    def _close(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            below = self._freeze(self.path.pop())
            self.path[-1][1].append((self.last[len(self.path) - 1], below))

    def add(self, word: bytes) -> None:
        """Words come in rising order, each once."""
        same, most = 0, min(len(word), len(self.last))
        while same < most and word[same] == self.last[same]:
            same += 1
        self._close(same)
        self.path += [[False, []] for _ in word[same:]]
        self.path[-1][0] = True
        self.last = word

    def finish(self) -> "Transducer":
        self._close(0)
        root = self._freeze(self.path[0])
        keys, targets, skips = [], [], []
        for state, (final, arcs) in enumerate(self.states):
            before = int(final)
            for byte, target in arcs:
                keys.append(state << 8 | byte)
                targets.append(target)
                skips.append(before)
                before += self.sizes[target]
        final = np.array([s[0] for s in self.states], bool)
        return Transducer(*(np.array(x, np.int64) for x in (keys, targets, skips)), final, root)


class Transducer:
    def __init__(self, keys: np.ndarray, targets: np.ndarray, skips: np.ndarray, final: np.ndarray, root: int):
        self.keys, self.targets, self.skips, self.final, self.root = keys, targets, skips, final, root

    def dump(self) -> bytes:
        arcs = np.concatenate([[len(self.keys), self.root], self.keys, self.targets, self.skips]).astype("<i8").tobytes()
        return arcs + self.final.astype(np.uint8).tobytes()

    @staticmethod
    def load(data: bytes) -> "Transducer":
        n, root = np.frombuffer(data, "<i8", 2).tolist()
        arcs = np.frombuffer(data, "<i8", 3 * n, 16)
        return Transducer(arcs[:n], arcs[n : 2 * n], arcs[2 * n :], np.frombuffer(data, np.uint8, offset=16 + 24 * n).astype(bool), root)

    def ordinals(self, words: pa.Array) -> np.ndarray:
        """The ordinal of each word (binary), -1 for one that is not kept; all words go on by a byte at a time."""
        words = words.cast(pa.large_binary())
        _, offsets, letters = words.buffers()
        borders = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
        data = np.frombuffer(letters, np.uint8) if letters is not None else np.zeros(0, np.uint8)
        starts, lengths = borders[:-1], np.diff(borders)
        out = np.full(len(words), -1)
        live = np.arange(len(words))
        state, sums = np.full(len(words), self.root), np.zeros(len(words), np.int64)
        at = 0
        while len(live):
            ended = lengths[live] == at
            done = ended & self.final[state]
            out[live[done]] = sums[done]
            live, state, sums = live[~ended], state[~ended], sums[~ended]
            if not len(live) or not len(self.keys):
                break
            wanted = state << 8 | data[starts[live] + at]
            arc = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[arc] == wanted
            live, arc, sums = live[hit], arc[hit], sums[hit]
            sums += self.skips[arc]
            state = self.targets[arc]
            at += 1
        return out

    def word(self, ordinal: int) -> bytes:
        """The word with this ordinal."""
        state, out, left = self.root, bytearray(), ordinal
        while not (self.final[state] and left == 0):
            first, end = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            arc = int(np.searchsorted(self.skips[first:end], left, "right")) - 1 + first
            out.append(int(self.keys[arc]) & 255)
            left -= int(self.skips[arc])
            state = int(self.targets[arc])
        return bytes(out)


def transducers(kept: DataFrame) -> DataFrame:
    """(shard, first, size, machine): a transducer for each range of the sorted kept terms, as many as shuffle partitions at most."""
    n = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder, first, size = Builder(), None, 0
        for batch in batches:
            for lang, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist()):
                word = lang.encode() + BAR + term.encode()
                first = first or word
                builder.add(word)
                size += 1
        if size:
            yield pa.RecordBatch.from_arrays(
                [pa.array([first]), pa.array([size], pa.int64()), pa.array([builder.finish().dump()])], ["first", "size", "machine"]
            )

    # the bytes of language, bar and term sort as the two columns only if no language begins another, so the bytes decide
    place = F.concat(F.encode("lang", "utf-8"), F.lit(BAR), F.encode("term", "utf-8"))
    ranged = kept.withColumn("place", place).repartitionByRange(n, "place").sortWithinPartitions("place").select("lang", "term")
    built = materialize(ranged.mapInArrow(build, "first binary, size long, machine binary"), "transducers")
    # one row for each range
    order = Window.orderBy("first")
    numbered = built.select("first", "size", (F.row_number().over(order) - 1).alias("shard"), (F.sum("size").over(order) - F.col("size")).alias("offset"))
    return materialize(built.drop("size").join(numbered, "first"), "vocabulary")


def shard_list(shards: DataFrame) -> list[tuple[bytes, int]]:
    """(first word, ordinals before) of each range: at most one for each shuffle partition."""
    return [(bytes(r["first"]), r["offset"]) for r in shards.select("first", "offset").orderBy("first").collect()]


def through(shards: DataFrame, streams: DataFrame, work, schema: str) -> DataFrame:
    """``work(transducer, offset, payload)`` on every payload of ``streams`` (shard, payload): the machine of a range comes
    first, its streams follow one by one."""
    machines = shards.select("shard", F.lit(0).alias("kind"), "offset", F.col("machine").alias("payload"))
    rows = streams.select("shard", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("offset"), "payload").unionByName(machines)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, offset = None, 0
        for batch in batches:
            for kind, before, payload in zip(*(batch.column(c).to_pylist() for c in ("kind", "offset", "payload"))):
                if kind == 0:
                    machine, offset = Transducer.load(payload), before
                else:
                    yield from work(machine, offset, payload)
        trim()

    return rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(walk, schema)


def packed(part: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(part)
    return sink.getvalue().to_pybytes()


def unpacked(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all().combine_chunks()


def recount(docs: DataFrame, shards: DataFrame, bounds: list[tuple[bytes, int]]) -> DataFrame:
    """(lang, source, ordinal, n): how often each kept term occurs in each source of its language."""
    firsts = [first for first, _ in bounds]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tallies(batches, ["lang", "source", "term"], once=False):
            part = part.combine_chunks()
            lang, term = (part[c].combine_chunks().cast(pa.large_binary()) for c in ("lang", "term"))
            coded = pc.binary_join_element_wise(lang, term, pa.scalar(BAR, pa.large_binary())).dictionary_encode()
            sorted_ = pc.sort_indices(coded.dictionary)
            words = coded.dictionary.take(sorted_)
            place = np.empty(len(words), np.int64)
            place[sorted_.to_numpy()] = np.arange(len(words))
            codes = place[coded.indices.to_numpy()]
            order = np.argsort(codes, kind="stable")
            names = pa.schema([("lang", pa.string()), ("source", pa.string())])
            rows = part.select(["lang", "source"]).cast(names).append_column("n", part["n"]).take(pa.array(order))
            listed = words.to_pylist()
            cuts = [*(bisect_left(listed, first) for first in firsts), len(listed)]  # words before the first kept term go to none
            edges = np.searchsorted(codes[order], cuts).tolist()
            for shard, (low, high, a, b) in enumerate(zip(cuts, cuts[1:], edges, edges[1:])):
                if a < b:
                    own = pa.DictionaryArray.from_arrays(pa.array((codes[order[a:b]] - low).astype(np.int32)), words.slice(low, high - low))
                    stream = packed(rows.slice(a, b - a).append_column("word", own))
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([stream])], ["shard", "payload"])

    def count(machine: Transducer, offset: int, payload: bytes) -> Iterator[pa.RecordBatch]:
        part = unpacked(payload)
        words = part["word"].combine_chunks()
        ordinals = machine.ordinals(words.dictionary)[words.indices.to_numpy()]
        kept = np.flatnonzero(ordinals >= 0)
        out = part.select(["lang", "source", "n"]).take(pa.array(kept)).append_column("ordinal", pa.array(ordinals[kept] + offset))
        yield from out.to_batches()

    streams = docs.mapInArrow(route, "shard int, payload binary")
    counted = through(shards, streams, count, "lang string, source string, n long, ordinal long")
    return counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def spell(ordinals: DataFrame, shards: DataFrame, bounds: list[tuple[bytes, int]]) -> DataFrame:
    """(ordinal, item): the terms of some ordinals."""
    offsets = [offset for _, offset in bounds]

    @F.arrow_udf("int")
    def shard_of(ordinal: pa.Array) -> pa.Array:
        return pa.array((np.searchsorted(offsets, ordinal.to_numpy(zero_copy_only=False), "right") - 1).astype(np.int32))

    def walked(machine: Transducer, offset: int, payload: bytes) -> Iterator[pa.RecordBatch]:
        term = machine.word(int(payload) - offset).split(BAR)[1].decode()
        yield pa.RecordBatch.from_arrays([pa.array([int(payload)], pa.int64()), pa.array([term])], ["ordinal", "item"])

    wanted = ordinals.select("ordinal").distinct().select(shard_of("ordinal").alias("shard"), F.col("ordinal").cast("string").cast("binary").alias("payload"))
    return through(shards, wanted, walked, "ordinal long, item string")


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / total), exact."""
    return F.lit(1).cast("long") + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)"), total.cast("decimal(20,0)"))


def pair_values(sparse: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value): the divergence of all ordered pairs of sources of a language.

    ``sparse``: (lang, source, ordinal, p) where a source holds a term; ``groups``: (lang, source, number, p0) with the share of a term it
    does not hold; ``langs``: (lang, first, v). A cell is WIDTH ordinals of up to two blocks of SOURCES sources.
    """
    blocks = groups.groupBy("lang").agg(F.floor(F.max("number") / SOURCES).alias("last"))
    cells = langs.join(blocks, "lang").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("v") - 1) / WIDTH), F.lit(0)))))
    # a row that tells of the source itself, so that one without any term of a chunk takes part in it
    own = groups.join(cells, "lang").select("lang", "source", "number", "last", "chunk", F.lit(-1).cast("long").alias("place"), F.col("p0").alias("p"), "v")
    held = (
        sparse.join(groups.select("lang", "source", "number"), ["lang", "source"]).join(langs.join(blocks, "lang"), "lang")
        .withColumn("at", F.col("ordinal") - F.col("first"))
        .select("lang", "source", "number", "last", F.floor(F.col("at") / WIDTH).alias("chunk"), (F.col("at") % WIDTH).alias("place"), "p", "v")
    )
    block = F.floor(F.col("number") / SOURCES)
    dealt = own.unionByName(held).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    dealt = dealt.withColumns({"low": F.least(block, "other"), "high": F.greatest(block, "other"), "block": block}).drop("other", "last")
    kind = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def compare(cell: pa.Table) -> pa.Table:
        if not len(cell):
            return kind.empty_table()
        chunk, v, low, high = (cell[c][0].as_py() for c in ("chunk", "v", "low", "high"))
        width = max(0, min(WIDTH, v - chunk * WIDTH))
        number, place, p = (cell[c].to_numpy() for c in ("number", "place", "p"))
        heads = np.flatnonzero(place < 0)
        heads = heads[np.argsort(number[heads])]
        numbers, names = number[heads], cell["source"].take(pa.array(heads)).combine_chunks()
        shares = np.repeat(p[heads][:, None], width, axis=1)
        inner = place >= 0
        shares[np.searchsorted(numbers, number[inner]), place[inner]] = p[inner]
        first = np.flatnonzero(numbers // SOURCES == low)
        second = np.flatnonzero(numbers // SOURCES == high)
        left, right, values = [], [], []
        for i in first.tolist():
            gap = shares[second] - shares[i]
            value = (gap * gap // (shares[second] + shares[i])).sum(1, dtype=np.int64)
            real = second != i
            left.append(np.full(int(real.sum()), i))
            right.append(second[real])
            values.append(value[real])
        a, b, value = (np.concatenate(x).astype(np.int64) for x in (left, right, values))
        if low != high:  # the two blocks meet only here, so both directions
            a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.tile(value, 2)
        lang = pa.array([cell["lang"][0].as_py()] * len(a), pa.string())
        return pa.Table.from_arrays([lang, names.take(pa.array(a)), names.take(pa.array(b)), pa.array(value)], schema=kind)

    parts = dealt.groupBy("lang", "chunk", "low", "high").applyInArrow(compare, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the other sources of its language, and its most raised terms."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    shards = transducers(vocabulary(rows.select("lang", "text"), support))
    bounds = shard_list(shards)
    counts = materialize(recount(rows, shards, bounds), "term-counts")
    terms = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n"))
    # every kept term occurs in its language, so these are all
    known = terms.groupBy("lang").agg(F.min("ordinal").alias("first"), F.count("*").alias("v"), F.sum("n").alias("total"))
    names = materialize(rows.select("lang", "source").distinct(), "sources")
    zero = F.lit(0).cast("long")
    langs = materialize(
        names.select("lang").distinct().join(known, "lang", "left").select("lang", *[F.coalesce(c, zero).alias(c) for c in ("first", "v", "total")]), "languages"
    )
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("held"))
    weight = F.coalesce("held", zero) + 2 * F.col("v")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1  # of a source, so that sources can be cut into blocks
    groups = names.withColumn("number", number.cast("long")).join(sizes, ["lang", "source"], "left").join(langs.select("lang", "v"), "lang")
    # without kept terms there is no share; nothing is summed over it
    groups = materialize(
        groups.select("lang", "source", "number", weight.alias("weight"), F.when(weight > 0, share(zero, weight)).otherwise(zero).alias("p0")), "source-sizes"
    )
    sparse = materialize(
        counts.join(groups.select("lang", "source", "weight"), ["lang", "source"]).select("lang", "source", "ordinal", share(F.col("n"), F.col("weight")).alias("p")),
        "source-shares",
    )
    whole = terms.join(langs, "lang").select("lang", "ordinal", share(F.col("n"), F.col("total") + 2 * F.col("v")).alias("q"))
    raised = sparse.join(whole, ["lang", "ordinal"]).filter("p > q").select("lang", "source", "ordinal", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = materialize(raised.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top), "raised-terms")
    spelled = best.join(spell(best, shards, bounds), "ordinal").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    pairs = pair_values(sparse, groups.select("lang", "source", "number", "p0"), langs.select("lang", "first", "v"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return ranked.unionByName(spelled)


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
w AS (SELECT k, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= {SUPPORT}),
groups AS (SELECT DISTINCT lang, source FROM d),
seen AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN seen s USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + ({SCALE}::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p FROM cells),
q0 AS (SELECT lang, term, sum(n) AS n FROM seen GROUP BY ALL),
q AS (SELECT lang, term, 1 + ({SCALE}::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q FROM q0),
far AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
