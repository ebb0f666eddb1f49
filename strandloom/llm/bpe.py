"""Byte-level BPE by Spark's higher-order functions.

Texts are cut into words by the tokenizer's pattern.  A word's bytes become ids, and
``aggregate`` folds merges over them: in each step the adjacent pair of least rank,
the leftmost of equals, becomes one id, until no pair has a rank.  A word is one array,
whose elements hold an id, its place, and the rank of its pair with the next id.  Ranks are a
literal map: two constant arrays that form a hash table without collisions, from the
pair of ids to its rank.  The constants reach the plan as one row, a scalar subquery
that Spark evaluates once; as literals in the text of the plan they took gigabytes.
Words of more than ``LONG`` bytes merge all places of the best pair in one step, by
replacing in a string of ids.

Words repeat, so the ``FREQUENT`` most frequent distinct words of the corpus, of
``LONG`` bytes at most, are folded once and looked up in a constant map from then on;
this bounds the constants.  Any other word is folded where it stands.

Decoding looks up each id's bytes in a constant array and joins the pieces, a character
for each byte.

Defined cases: null text counts as empty; an empty text has no ids and decodes to no
bytes; repeated rows and ids have a row each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import random
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.runtime import Scratch, text_of, trimmed

FREQUENT = 1 << 19
SAMPLE = 20_000
LONG = 48
#: What no pair has in the table of ranks.
NONE = 0xFFFF << 16
#: Bits of a place in a word of ``LONG`` bytes at most with two edges; with the id before it.
SHORT, LOW = 6, 22
#: Bits of a place in a longer word, beside a rank.
PLACE = 30
#: Stands for the least rank before it is known.
ASK = -1

#: Fixed value: the tokenizer's pattern, with white space as Unicode has it.
SPACE = r"\t\n\x0B\f\r \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def load(path: str) -> list[bytes]:
    """Bytes of each id, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(word) for word, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def pair_table(vocabulary: list[bytes]) -> tuple[list[int], list[int]]:
    """Ranks of pairs as a matrix of left by right, its rows laid over each other.

    Row ``left`` begins at ``offsets[left]``; where it has a rank for ``right``, the
    table has left * 65536 + rank at offset + right, so that an exclusive or with
    left * 65536 is the rank, and at least 65536 anywhere else.
    """
    ids = {word: i for i, word in enumerate(vocabulary)}
    rows: dict[int, dict[int, int]] = {}
    for word, rank in ids.items():
        for k in range(1, len(word)):
            left, right = ids.get(word[:k]), ids.get(word[k:])
            if left is not None and right is not None:
                rows.setdefault(left, {})[right] = rank
    draw = random.Random(1)
    offsets, taken, reach = [0] * (len(vocabulary) + 1), {}, 1
    for left, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        offset, tries = 0, 0
        while any(offset + right in taken for right in row):
            tries += 1
            reach += tries % 64 == 0 and len(vocabulary) // 8
            offset = draw.randrange(reach)
        offsets[left] = offset
        taken.update((offset + right, left << 16 | rank) for right, rank in row.items())
    return offsets, [taken.get(k, NONE) for k in range(reach + len(vocabulary) + 1)]


class Bpe:
    """One vocabulary: its constants, and expressions that encode and decode with them.

    ``t`` is a struct column of the constants; see ``over``.
    """

    def __init__(self, path: str) -> None:
        self.vocabulary = load(path)
        self.offsets, self.table = pair_table(self.vocabulary)
        self.edge = len(self.vocabulary)  # an id with no pairs

    def constants(self, scratch: Scratch, name: str) -> DataFrame:
        """One row: byte ids, offsets, and the table above ``LOW`` bits."""
        ids = {word: i for i, word in enumerate(self.vocabulary)}
        columns = {
            "bytes": pa.array([[ids[bytes([b])] for b in range(256)]], pa.list_(pa.int64())),
            "offsets": pa.array([self.offsets], pa.list_(pa.int64())),
            "table": pa.array([[x << LOW for x in self.table]], pa.list_(pa.int64())),
        }
        return scratch.save(scratch.spark.createDataFrame(pa.table(columns)), name)

    def pieces(self, scratch: Scratch, name: str) -> DataFrame:
        """One row: each id's bytes as Latin-1.

        In a table of its own: a plan that encodes and decodes would hold the known words twice, else.
        """
        pieces = [word.decode("latin-1") for word in self.vocabulary]
        return scratch.save(scratch.spark.createDataFrame(pa.table({"pieces": pa.array([pieces], pa.list_(pa.string()))})), name)

    def knowing(self, top: DataFrame, scratch: Scratch, name: str) -> DataFrame:
        """The constants' row with ``known``: the words of ``top`` (saved) with their ids, in maps by the word's hash.

        Executors fold them and lay them out; the driver only gets the row, as part of a plan.
        """
        bare = self.constants(scratch, f"{name}_bare")
        slots = top.count() // 4 | 1  # a map has about 24 bytes of its own
        slot = F.pmod(F.xxhash64("word"), F.lit(slots))
        words = self.folded(top, bare).select(slot.alias("slot"), F.struct("word", "ids").alias("entry"))
        rest = scratch.spark.range(slots).select(F.col("id").alias("slot"), F.lit(None).alias("entry"))  # a map for each slot
        maps = words.union(rest).groupBy("slot").agg(F.collect_list("entry").alias("entries"))
        row = maps.agg(F.sort_array(F.collect_list(F.struct("slot", "entries"))).alias("maps"))
        known = F.transform("maps", lambda x: F.map_from_entries(x["entries"])).alias("known")
        return scratch.save(row.select(known, bare.select(F.struct("*")).scalar().alias("_b")).select("known", "_b.*"), name)

    def folded(self, top: DataFrame, constants: DataFrame) -> DataFrame:
        """word, ids of the words of ``top``, in four tasks for each core."""
        return over(top.repartition(4 * top.sparkSession.sparkContext.defaultParallelism), constants, "word", "ids", self.encoded)

    def _ranked(self, left: Column, right: Column, low: Column, t: Column) -> Column:
        """Rank << LOW | low, of the pair of two ids; low is left << SHORT | place, and a rank of 65536 or more is none."""
        at = F.get(t["offsets"], left.cast("int")) + right
        return F.get(t["table"], at).bitwiseXOR(F.shiftleft(left, 16 + LOW) + low)

    def _folded(self, ids: Column, t: Column) -> Column:
        """``ids``, with an id that has no pairs at either end, after all merges.

        Elements hold their place, so all of them differ: a merge takes the pair's two
        and the one before by value, and puts two there, of which one has a new rank only.
        """
        low = lambda bits: F.lit((1 << bits) - 1).cast("bigint")
        id_of = lambda x: F.shiftright(x, SHORT).bitwiseAND(low(16))

        def merged(s: Column, least: Column, k: Column) -> Column:
            """``least`` is the element at k, from 1; its rank is the new id."""
            made, right, after = F.shiftright(least, LOW), F.get(s, k), F.get(s, k + 1)
            one = _let(made, lambda m: self._ranked(m, id_of(after), F.shiftleft(m, SHORT) + least.bitwiseAND(low(SHORT)), t))
            before = _let(F.get(s, k - 2), lambda x: self._ranked(id_of(x), made, x.bitwiseAND(low(LOW)), t))
            rest = F.array_remove(F.array_remove(F.array_remove(s, F.get(s, k - 2)), least), right)
            return F.array_insert(F.array_insert(rest, k - 1, one), k - 1, before)

        def step(s: Column, _: Column) -> Column:
            some = lambda least: _let(F.array_position(s, least).cast("int"), lambda k: merged(s, least, k))
            return _let(F.array_min(s), lambda least: F.when(least < 65536 << LOW, some(least)).otherwise(s))

        last = F.lit(NONE << LOW | self.edge << SHORT).cast("bigint")
        begin = F.transform(ids, lambda x, i: F.coalesce(self._ranked(x, F.get(ids, i + 1), F.shiftleft(x, SHORT) + i, t), last))
        steps = F.sequence(F.lit(1), F.size(ids) - 3)  # n bytes have n - 1 merges at most
        return F.aggregate(steps, begin, step, lambda s: F.transform(F.slice(s, F.lit(2), F.size(s) - 2), id_of))

    def _pair(self, x: Column, y: Column, t: Column) -> Column:
        """Rank << PLACE | place of the pair of two elements, each id << PLACE | place; a rank of 65536 or more is none."""
        left, right = F.shiftright(x, PLACE), F.shiftright(y, PLACE)
        rank = F.shiftright(F.get(t["table"], F.get(t["offsets"], left.cast("int")) + right), LOW).bitwiseXOR(F.shiftleft(left, 16))
        return F.shiftleft(rank, PLACE) + x.bitwiseAND(F.lit((1 << PLACE) - 1))

    def _folded_long(self, ids: Column, t: Column) -> Column:
        """As ``_folded``, with all places of the least pair, the leftmost first, merged in one step; looks and merges take turns."""
        start = F.transform(ids, lambda x, i: F.shiftleft(x, PLACE) + i)
        named = lambda x: F.concat(F.lit("<"), F.lpad(F.shiftright(x, PLACE).cast("string"), 5, "0"))

        def step(s: Column, _: Column) -> Column:
            pairs = F.transform(s["ids"], lambda x, i: self._pair(x, F.get(s["ids"], i + 1), t))
            sought = F.struct(s["ids"].alias("ids"), F.coalesce(F.array_min(pairs), F.lit(NONE << PLACE)).alias("least"))
            k = s["least"].bitwiseAND(F.lit((1 << PLACE) - 1)).cast("int")
            text = F.array_join(F.transform(s["ids"], named), "")
            text = F.replace(text, F.concat(named(F.get(s["ids"], k)), named(F.get(s["ids"], k + 1))), named(s["least"]))
            ids = F.transform(F.split(F.substring(text, 2, 2**31 - 1), "<"), lambda x, i: F.shiftleft(x.cast("bigint"), PLACE) + i)
            one = F.struct(ids.alias("ids"), F.lit(ASK).cast("bigint").alias("least"))
            return F.when(s["least"] == ASK, sought).when(s["least"] < 65536 << PLACE, one).otherwise(s)

        begin = F.struct(start.alias("ids"), F.lit(ASK).cast("bigint").alias("least"))
        return F.aggregate(F.sequence(F.lit(1), 2 * F.size(start)), begin, step, lambda s: F.transform(F.slice(s["ids"], F.lit(2), F.size(s["ids"]) - 2), lambda x: F.shiftright(x, PLACE)))

    def encoded(self, word: Column, t: Column) -> Column:
        """Ids of one word, which isn't empty."""
        latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
        bytes_of = F.transform(F.filter(F.split(latin, ""), lambda x: x != ""), lambda x: F.get(t["bytes"], F.ascii(x)))
        edge = F.array(F.lit(self.edge).cast("bigint"))
        return _let(F.concat(edge, bytes_of, edge), lambda x: F.when(F.size(x) <= LONG + 2, self._folded(x, t)).otherwise(self._folded_long(x, t))).cast("array<int>")

    def ids(self, words: Column, t: Column) -> Column:
        """Ids of an array of words in one array; a word's are looked up if it is known, else folded."""

        def one(word: Column, known: Column) -> Column:
            slot = F.pmod(F.xxhash64(word), F.size(known)).cast("int")
            return F.coalesce(F.try_element_at(F.get(known, slot), word), self.encoded(word, t))

        return _let(t["known"], lambda known: F.flatten(F.transform(words, lambda word: one(word, known))))

    def decoded(self, ids: Column, t: Column) -> Column:
        """Bytes of an array of ids."""
        return _let(t["pieces"], lambda pieces: F.encode(F.array_join(F.transform(ids, lambda i: F.get(pieces, i.cast("int"))), ""), "ISO-8859-1"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once: a fold over nothing, with a finish."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda x, _: x, body)


def over(df: DataFrame, constants: DataFrame, uses: str, name: str, body: Callable[[Column, Column], Column]) -> DataFrame:
    """``df`` with column ``name``, made by ``body`` of column ``uses`` and the constants' struct.

    Column and constants are each named once, so the optimizer merges the
    projections and the constants are never copied into a row.
    """
    rest = [c for c in df.columns if c != uses]
    given = df.select(*rest, F.col(uses).alias("_v"), constants.select(F.struct("*")).scalar().alias("_t"))
    both = _let(F.struct("_v", "_t"), lambda x: _let(x["_t"], lambda t: F.struct(x["_v"].alias("v"), body(x["_v"], t).alias("o"))))
    return given.select(*rest, both.alias("_o")).select(*rest, F.col("_o.v").alias(uses), F.col("_o.o").alias(name))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def drawn(df: DataFrame, scratch: Scratch, text_col: str = "text", most: int = FREQUENT, sample: int = SAMPLE) -> DataFrame:
    """word, at most ``most`` rows, saved.

    They are the most frequent words of about ``sample`` rows, drawn by a hash of the
    text; one that occurs there once is likely to occur among the other rows, too.
    Only the time that encoding takes depends on which words are drawn.
    """
    text = text_of(text_col)
    rows = max(1, df.count())
    some = df.where(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < min(1 << 20, (sample << 20) // rows))
    seen = some.select(F.explode(words(text)).alias("word")).groupBy("word").count()
    top = seen.where(F.octet_length("word") <= LONG).orderBy(F.desc("count"), "word").limit(most).select("word")
    return scratch.save(top, "frequent")


def frequent(df: DataFrame, bpe: Bpe, scratch: Scratch, text_col: str = "text", most: int = FREQUENT, sample: int = SAMPLE) -> pa.Table:
    """word, ids of the ``drawn`` words, on the driver."""
    return bpe.folded(drawn(df, scratch, text_col, most, sample), bpe.constants(scratch, "bare")).toArrow()  # at most ``most`` short rows


class Codec:
    """Encodes and decodes the rows of one corpus."""

    def __init__(self, df: DataFrame, bpe: Bpe, text_col: str = "text", most: int = FREQUENT) -> None:
        self.bpe, self.df, self.text_col = bpe, df, text_col
        scratch = Scratch(df.sparkSession, "bpe")
        self.constants = bpe.knowing(drawn(df, scratch, text_col, most), scratch, "constants")
        self.pieces = bpe.pieces(scratch, "pieces")
        trimmed()

    def encode(self, id_col: str = "doc_id") -> DataFrame:
        """id_col and ids, an array of ids per row of the corpus."""
        split = self.df.select(F.col(id_col), words(text_of(self.text_col)).alias("words"))
        return over(split, self.constants, "words", "ids", self.bpe.ids).select(id_col, "ids")

    def decode(self, rows: DataFrame, ids_col: str = "ids") -> DataFrame:
        """``rows`` with column decoded, the bytes of their ids."""
        return over(rows, self.pieces, ids_col, "decoded", self.bpe.decoded)
