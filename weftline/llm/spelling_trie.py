"""Spelling variants of the words of a corpus, by a trie that is two tables and a frontier of states.

The trie of all words is an edge table: a node is the hash of a prefix, an edge leads from one
branching node to the next and carries the letters between.  A state (word, position, node, edits)
says that the word's letters before the position lead to the node with so many edits.  States meet
the edges level by level; a state that reaches the end of a word of the trie with one edit has
found a neighbour.

Two words one edit apart share the first half of the longer one or the second.  So every word is
also entered backwards, and a state starts at the middle of its word, on the word's own path, where
few words are left below a node; a walk from the root would try every letter at nodes that all words
share.  Being one edit apart is mutual, so states leave a letter out or replace it by a later one,
and what they find is a neighbour of the word and has the word as its neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.buffers import blocks, mix, range_hashes, text_bytes
from weftline.workspace import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What closes the paths of the trie, forwards and backwards: the characters after z, whose bits follow z's.
ENDS = ("{", "|")
LEAST_LETTERS = 7


def occurrences(df: DataFrame, key: str, text: str, least: int, drop_every: int) -> DataFrame:
    """``word``: one row for each run of ``least`` Latin letters and more that a text holds.

    A run whose hash with the key is divisible by ``drop_every`` loses the letter the hash names.
    """
    lowered = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    found = F.regexp_extract_all(lowered, F.lit(rf"[a-zÀ-ÿ]{{{least},}}"), F.lit(0))
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    runs = df.select(name.alias("name"), F.explode(found).alias("run"))
    h = F.crc32(F.concat("name", F.lit(":"), "run").cast("binary"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(
        F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run"))
    )
    hashed = runs.select("run", h.alias("h"))
    return hashed.select(F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_letters: int, least_count: int) -> DataFrame:
    """Distinct words with their number ``n`` of occurrences and an ``id``, as a written table."""
    counted = (
        words.where(F.char_length("word") >= least_letters)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_count)
    )
    return materialize(counted.withColumn("id", F.monotonically_increasing_id()), "vocabulary")


def _latin(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of Latin words, one byte each, and the offsets of the words."""
    data, offsets = text_bytes(column)
    lead = data == 0xC3
    code = data.copy()
    code[1:][lead[:-1]] += 0x40
    place = np.r_[0, np.cumsum(~lead)]
    return code[~lead], place[offsets]


def prefix_rows(words: pa.Array, ids: np.ndarray, backwards: bool) -> tuple[np.ndarray, ...]:
    """(node, depth, path, lo, hi) of every prefix from the middle of its word on.

    ``lo`` and ``hi`` have the bit of the letter that follows; ``path`` is twice the id, and one
    more backwards.
    """
    code, offsets = _latin(words)
    if backwards:
        code, offsets, ids = code[::-1], len(code) - offsets[::-1], ids[::-1]
    size = np.diff(offsets)
    first = (size + 1) // 2 if backwards else size // 2
    rows = size - first + 1
    word = np.repeat(np.arange(len(size)), rows)
    depth = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows) + first[word]
    start = offsets[:-1][word]
    node = range_hashes(code, start, start + depth)
    node = mix(node ^ np.uint64(0x9E3779B97F4A7C15)) if backwards else node
    ended = depth == size[word]
    letter = np.where(ended, ord(ENDS[backwards]), np.r_[code, 0][start + depth]).astype(np.uint64)
    one = np.uint64(1)
    plain = letter < 128
    lo = np.where(plain, one << ((letter - np.uint64(97)) & np.uint64(63)), 0).astype(np.uint64)
    hi = np.where(plain, 0, one << ((letter - np.uint64(192)) & np.uint64(63))).astype(np.uint64)
    path = 2 * ids[word] + backwards
    return node.view(np.int64), depth.astype(np.int32), path, lo.view(np.int64), hi.view(np.int64)


def _prefixes(words: DataFrame) -> DataFrame:
    names = ["node", "depth", "path", "lo", "hi"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "word", 1 << 16):
            ids = np.asarray(batch.column("id"))
            for backwards in (False, True):
                rows = prefix_rows(batch.column("word"), ids, backwards)
                yield pa.RecordBatch.from_arrays([*map(pa.array, rows)], names=names)

    return words.select("word", "id").mapInArrow(emit, "node long, depth int, path long, lo long, hi long")


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``paths`` (a word's branching nodes from its middle on) and ``edges`` between such nodes.

    A node branches if its prefixes are followed by two letters at least; bit sets of the letters
    are combined before the shuffle, so a prefix that a third of all words share costs a row a task.
    Both are written tables.  The last edge of a word has a second hash, of the whole path, as ``lo``: prefixes of equal hashes
    share a node, and a state that came by another prefix than its word's is told apart by it.

    Spark takes prefixes for no more bytes than the words they are made of; joins with them, and with
    other rows made of lists, are told to merge, as they would be broadcast at a hundred times the limit.
    """
    prefixes = _prefixes(words)
    branching = (
        prefixes.groupBy("node")
        .agg(F.bit_or("lo").alias("lo"), F.bit_or("hi").alias("hi"))
        .where(F.bit_count("lo") + F.bit_count("hi") > 1)
    )
    stops = (
        prefixes.select("node", "depth", "path")
        .join(branching.hint("merge"), "node")
        .groupBy("path")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "node", "lo", "hi"))).alias("stops"))
        .select(F.shiftright("path", 1).alias("id"), (F.col("path") % 2 == 1).alias("back"), "stops")
    )
    spelt = F.when(F.col("back"), F.concat(F.reverse("word"), F.lit(ENDS[1]))).otherwise(
        F.concat("word", F.lit(ENDS[0]))
    )
    paths = materialize(stops.join(words.hint("merge"), "id").select(spelt.alias("path"), "n", "stops"), "trie-paths")
    edge = F.expr(
        "explode(transform(stops, (s, i) -> named_struct('node', s.node, 'label', substring(path, s.depth + 1, "
        "coalesce(get(stops, i + 1).depth, length(path)) - s.depth), 'child', get(stops, i + 1).node, "
        "'lo', get(stops, i + 1).lo, 'hi', get(stops, i + 1).hi)))"
    )
    edges = (
        paths.select(edge.alias("edge"), F.xxhash64("path").alias("whole"), "n")
        .select(
            *[f"edge.{c}" for c in ("node", "label", "child", "hi")],
            F.coalesce("edge.lo", "whole").alias("lo"),
            F.when(F.col("edge.child").isNull(), F.col("n")).alias("near_n"),
        )
        .dropDuplicates(["node", "label", "child", "lo"])
        .withColumn("letter", F.substring("label", 1, 1))
    )
    return paths, materialize(edges, "trie-edges")


def _letter(path: str, place: Column) -> Column:
    return F.substring(path, place + 1, F.lit(1))


def _rest(text: str, place: Column) -> Column:
    return F.substring(text, place + 1, F.char_length(text))


def _kept(reached: DataFrame) -> DataFrame:
    """States at the end of a word, and those whose node has an edge for the next letter."""
    code = F.ascii(_letter("near", F.col("position")))
    has = F.expr("CASE WHEN code < 128 THEN bit_get(lo, code - 97) ELSE bit_get(hi, code - 192) END")
    ended = F.col("near_n").isNotNull()
    return (
        reached.withColumn("code", F.when(ended, F.lit(97)).otherwise(code))
        .where(F.when(ended, F.col("lo") == F.xxhash64("near")).otherwise(has == 1))
        .select("path", "n", "near", "position", "node", "near_n")
    )


def _first_edits(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """States after the edit: those without one are the nodes of the word's own path.

    The edit stands where the word and its neighbour first differ, so it is made on edges whose
    first letter is not the word's.  ``near`` is the path with its edit: what is still to be found
    in the trie, from ``position`` on.
    """
    size = F.char_length("path") - 1
    backwards = F.endswith("path", F.lit(ENDS[1]))
    middle = F.when(backwards, F.ceil(size / 2)).otherwise(F.floor(size / 2))
    own = (
        paths.select("path", "n", middle.alias("middle"), F.explode("stops").alias("stop"))
        .where(F.col("stop.depth") >= F.col("middle"))
        .select("path", "n", F.col("stop.depth").alias("at"), F.col("stop.node").alias("node"))
    )
    at, other = F.col("at"), F.col("letter")
    letter, following = _letter("path", at), _letter("path", at + 1)
    inside = ~letter.isin(*ENDS)
    tail = _rest("path", at + 1)
    replaced = ~other.isin(*ENDS) & (letter < other) & F.startswith(tail, _rest("label", F.lit(1)))
    deleted = (other == following) & (other != letter) & F.startswith(tail, F.col("label"))
    met = own.join(edges.hint("merge"), (own["node"] == edges["node"]) & inside & (replaced | deleted))
    start = F.substring("path", F.lit(1), at)
    end = at + F.char_length("label")
    ways = F.array(
        F.when(replaced, F.struct(F.concat(start, other, tail).alias("near"), end.alias("position"))),
        F.when(deleted, F.struct(F.concat(start, tail).alias("near"), end.alias("position"))),
    )
    reached = met.select(
        "path", "n", F.explode(ways).alias("way"), F.col("child").alias("node"), "lo", "hi", "near_n"
    )
    return _kept(reached.where("way IS NOT NULL").select("path", "n", "way.*", "node", "lo", "hi", "near_n"))


def _next_level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States after one more edge, which must hold just the next letters."""
    at = F.col("position")
    ahead = states.select("path", "n", "near", "position", "node", _letter("near", at).alias("letter"))
    met = ahead.join(edges, ["node", "letter"]).where(F.startswith(_rest("near", at), F.col("label")))
    reached = met.select(
        "path", "n", "near", (at + F.char_length("label")).alias("position"),
        F.col("child").alias("node"), "lo", "hi", "near_n",
    )
    return _kept(reached)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near, near_n): the words exactly one inserted, deleted or replaced letter away.

    ``words`` has ``id``, ``word`` (Latin letters without A-Z) and ``n``.  Every level is written,
    and the next one reads it; their number is that of the branching nodes in half a word.
    """
    paths, edges = trie(words)
    levels, level = [], _first_edits(paths, edges)
    while True:
        level = materialize(level, "trie-states")
        levels.append(level.where("near_n IS NOT NULL"))
        going = level.where("near_n IS NULL")
        if going.isEmpty():
            break
        level = _next_level(going, edges)
    found = levels[0]
    for one in levels[1:]:
        found = found.unionByName(one)
    backwards = F.endswith("path", F.lit(ENDS[1]))

    def spelt(path: str) -> Column:
        word = F.substring(path, F.lit(1), F.char_length(path) - 1)
        return F.when(backwards, F.reverse(word)).otherwise(word)

    found = found.select(backwards.alias("back"), spelt("path").alias("word"), "n", spelt("near").alias("near"), "near_n")
    half = F.substring("word", F.lit(1), F.floor(F.char_length("word") / 2).cast("int"))
    forwards_too = F.col("back") & F.startswith("near", half)
    both = F.array(
        F.struct("word", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return found.where(~forwards_too).select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, by doubling.

    Every form has ``ratio`` times the occurrences of its word, so chains end, and after few rounds.
    Files of such pairs are a fraction of what they take in memory, so their joins merge.
    """
    root = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = root.select(F.col("word").alias("root"), F.col("root").alias("further")).hint("merge")
        if root.join(further, "root", "left_semi").isEmpty():
            return root
        root = root.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        root = materialize(root, "spelling-roots")


def spelling_variants(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = 2,
    ratio: int = 10,
    drop_every: int = 31,
) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of the corpus.

    A word's form is its most frequent neighbour (of several the first in code-point order), if it
    is ``ratio`` times as frequent; the root is the end of the chain of forms, or the word itself.
    Null and empty texts have no words; a null key is the empty string; repeated rows count again;
    runs of any length are handled whole; other columns are not read, whatever they are called; an
    empty table gives an empty result.  ``ratio`` is 2 at least, so that chains end.
    """
    if ratio < 2 or least_letters < 2:
        raise ValueError("forms need a ratio of 2 and words of 2 letters at least")
    words = vocabulary(occurrences(df, key, text, least_letters, drop_every), least_letters, least_count)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = neighbours(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    often = -F.col("best.less")
    is_form = often >= ratio * F.col("n")
    judged = words.join(near.hint("merge"), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, often).alias("form_n"),
    )
    judged = materialize(judged, "spelling-forms")
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))
