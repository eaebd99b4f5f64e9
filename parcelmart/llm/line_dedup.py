"""Near-duplicate lines: an exact set-similarity join over the lines of all documents.

A line's tokens are its word shingles: runs of five words, which are runs of characters other than
0x20 and 0x09-0x0D, lower-cased; a line with fewer words is one token. Lines with equal token sets
form a class, which takes part once, with its first line.

The tokens of a class are ordered rare before common, and by hash among equals; classes that are similar
enough share a token within a prefix of any such order. Rarity is how often a token stands in the
prefixes by hash, counted over all classes, which is what its list of candidates would be: the tokens
above a share of all postings are common, by the binary logarithm of their count, and the prefixes that hold one
are taken anew. Pairs that meet are dropped by the length filter, the positional filter and by the parities of how many tokens
fall into each of 256 parts (where they differ, a token is not shared). The whole sets of the classes that are left
are made from the texts once more, and the pairs verified on them.
A line goes when an earlier line is similar.

Tokens are 64-bit hashes. The order is by id, then line number; everything is a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm.common import written

BLANKS = "[\\x20\\x09-\\x0D]+"
OTHER_BLANKS = ["\t", "\x0b", "\x0c", "\r", "  "]
COMMON_SHARE = 1 << 12  # a token is common if it has more than this part of all postings, so fewer are
LEAST_COMMON = 64  # and more than this number of them
CELL_BITS = 15  # size of the table of common tokens, which stands in the plan
RARE = b"0"  # in that table; a common token has a digit or letter by its count
LEVELS = b"123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOKEN_BITS = 23  # size of the filter for tokens that lines share
FILTER_BITS = 22  # size of the filter for lines to verify


WORDED = "[^\\x20\\x09-\\x0D]"
COPY = "further copy of a document without an id"


def with_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a column COPY. Rows without an id are documents of their own, so of those with equal
    texts all but one are further copies, whose lines with words all repeat those of the first."""
    unnamed = F.col(doc_id).cast("long").isNull()
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    alike = Window.partitionBy(F.xxhash64(F.col(text).cast("string"))).orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in plain)))
    return docs.filter(~unnamed).withColumn(COPY, F.lit(False)).unionByName(
        docs.filter(unnamed).withColumn(COPY, F.row_number().over(alike) > 1)
    )


def worded_lines(text: Column) -> Column:
    """The numbers of the lines that hold a word."""
    numbers = F.transform(F.split(text, "\n", -1), lambda x, k: F.when(x.rlike(WORDED), k))
    return F.filter(numbers, lambda k: k.isNotNull())


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id, text and a hash of the text; rows with the same id and text are one document."""
    body = F.col(text).cast("string")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("version"), body.alias("text"))


def _contents(documents: DataFrame) -> DataFrame:
    """The lines that hold a word."""
    lines = documents.select("doc_id", "version", F.posexplode(F.split("text", "\n", -1)).alias("line", "content"))
    return lines.filter(F.col("content").rlike(WORDED)).withColumn("content", F.trim("content"))


def _tokens(words: Column, shingle: int) -> Column:
    """The hash of each run of ``shingle`` words; fewer words are one run, as hashes skip what is null."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (shingle - 1), F.lit(1)))
    return F.transform(starts, lambda w, k: F.xxhash64(w, *(F.get(words, k + j) for j in range(1, shingle))))


def _token_sets(contents: DataFrame, shingle: int) -> DataFrame:
    """``contents`` with the sorted token hashes of each line in place of its content."""
    content = F.col("content")
    odd = F.lit(False)
    for blank in OTHER_BLANKS:
        odd = odd | F.contains(content, F.lit(blank))
    parts = F.filter(F.split(F.lower(content), BLANKS), lambda w: w != "")
    words = F.when(odd, parts).otherwise(F.split(F.lower(content), " "))  # most lines have single spaces only
    # an array of one array, so that the words are made once and every run takes them from there
    tokens = F.element_at(F.transform(F.array(words), lambda w: _tokens(w, shingle)), 1)
    return contents.select("doc_id", "version", "line", F.sort_array(F.array_distinct(tokens)).alias("keys"))


def _cells(rows: DataFrame, cell: Column, value: Column, bits: int) -> DataFrame:
    """One row with an array that has ``value`` (an aggregate) for each of a fixed number of cells."""
    grouped = rows.groupBy(cell.alias("id")).agg(value.alias("value"))
    return (
        rows.sparkSession.range(1 << bits)
        .join(grouped, "id", "left")
        .agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("value", F.lit(0).cast("long")).alias("value")))).alias("cells"))
        .select(F.expr("transform(cells, c -> c.value)").alias("cells"))
    )


def _bit(hashed: Column, bits: int) -> tuple[Column, Column]:
    """The word and the bit in it of a hash, in a table of 2**bits bits."""
    place = F.shiftrightunsigned(hashed, 64 - bits)
    return F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")


def _marks(hashes: DataFrame, bits: int, name: str) -> DataFrame:
    """A table of bits, as one row with an array of words, in which those of ``hashes`` (h) are set."""
    word, bit = _bit(F.col("h"), bits)
    set_bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return written(_cells(hashes, word, set_bits, bits - 6), name)


def _marked(hashed: Column, marks: DataFrame, bits: int) -> Column:
    word, bit = _bit(hashed, bits)
    found = F.element_at(marks.scalar(), (word + 1).cast("int"))
    return F.call_function("shiftright", found, bit).bitwiseAND(F.lit(1)) == 1


def _similar(percent: int, overlap: Column, n_a: Column, n_b: Column) -> Column:
    return (100 + percent) * overlap >= percent * (n_a + n_b)


PARITY = ["p0", "p1", "p2", "p3"]


def _with_parities(rows: DataFrame) -> DataFrame:
    """``rows`` with, in PARITY, bit k of word j: whether an odd number of the sorted ``keys`` falls into part
    64 * j + k of 256; a word has a quarter of the range of hashes."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))
    parity = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda bits, x: bits.bitwiseXOR(bit(x)))
    bounds = [F.lit(b).cast("long") for b in (-(1 << 62), 0, 1 << 62)]
    # the place that a bound would have among the keys is where its quarter begins
    begins = [F.array_position(F.sort_array(F.array_append("keys", b)), b).cast("int") for b in bounds]
    rows = rows.select("*", *(b.alias(f"begin{k}") for k, b in enumerate(begins, 1)))
    begins = [F.lit(1), *(F.col(f"begin{k}") for k in (1, 2, 3)), F.size("keys") + 1]
    parts = [F.slice("keys", begins[k], begins[k + 1] - begins[k]).alias(f"part{k}") for k in range(4)]
    rows = rows.select("*", *parts)
    # read twice, a part stays a column of its own, which Spark makes in compiled code
    words = [F.when(F.size(f"part{k}") > 0, parity(F.col(f"part{k}"))).otherwise(0).alias(p) for k, p in enumerate(PARITY)]
    return rows.select("*", *words).drop(*(f"begin{k}" for k in (1, 2, 3)), *(f"part{k}" for k in range(4)))


def _close(percent: int, a: str, b: str) -> Column:
    """Length and positional filter, and the bound that the parities set."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    left = F.least(n_a - F.col(f"{a}.pos"), n_b - F.col(f"{b}.pos"))
    apart = sum((F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in PARITY), F.lit(0))
    return (
        (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))
        & _similar(percent, left, n_a, n_b)
        & ((100 + percent) * (n_a + n_b - apart) >= 2 * percent * (n_a + n_b))
    )


def _prefix(keys: Column, percent: int) -> Column:
    n = F.size(keys)
    overlap = F.floor((percent * n + 99) / 100).cast("int")  # the least with a similar set
    return F.slice(keys, F.lit(1), n - overlap + 1)


def _mark(key: Column, common: bytes) -> Column:
    return F.substring(F.lit(common), (F.shiftrightunsigned(key, 64 - CELL_BITS) + 1).cast("int"), F.lit(1))


def _common_last(keys: Column, common: bytes) -> Column:
    """Sorted keys, with those whose cell has a level in ``common`` behind the others, by level and key."""
    rare = F.filter(keys, lambda k: _mark(k, common) == F.lit(RARE))
    rest = F.filter(keys, lambda k: _mark(k, common) != F.lit(RARE))
    ranked = F.sort_array(F.transform(rest, lambda k: F.struct(_mark(k, common).alias("level"), k.alias("key"))))
    return F.concat(rare, F.transform(ranked, lambda x: x["key"]))


PLACE = ["doc_id", "version", "line"]


class _Lines:
    def __init__(self, docs: DataFrame, percent: int, shingle: int, doc_id: str, text: str):
        if not 0 < percent <= 100:
            raise ValueError("percent must be in 1..100")
        if shingle < 1:
            raise ValueError("a shingle has at least one word")
        self.percent, self.shingle = percent, shingle
        self.documents = _documents(docs, doc_id, text)
        keys = F.col("keys")
        self.lines = written(
            _with_parities(_token_sets(_contents(self.documents), shingle)).select(
                *PLACE,
                F.xxhash64("keys").alias("cls"),
                F.size("keys").alias("n"),
                _prefix(keys, percent).alias("prefix"),
                *PARITY,
            ),
            "lines",
        )
        place = F.struct("doc_id", "line", "version")
        same = [F.any_value(c).alias(c) for c in ("n", "prefix", *PARITY)]
        self.classes = written(self.lines.groupBy("cls").agg(F.min(place).alias("at"), F.max(place).alias("last"), *same), "line-classes")

    def _sets(self, classes: DataFrame, name: str) -> DataFrame:
        """(cls, keys) of ``classes`` (cls, at), read from the texts of their first lines."""
        lines = classes.select("at.doc_id", "at.version", "at.line")
        here = F.xxhash64("doc_id", "version", "line")
        marks = _marks(lines.select(here.alias("h")), FILTER_BITS, f"{name}-lines")
        texts = _marks(lines.select(F.col("version").alias("h")), FILTER_BITS, f"{name}-texts")
        documents = self.documents.filter(_marked(F.col("version"), texts, FILTER_BITS))
        sets = _token_sets(_contents(documents).filter(_marked(here, marks, FILTER_BITS)), self.shingle)
        # the tables of bits let a few other lines pass, and rows may repeat a line
        return sets.select(F.xxhash64("keys").alias("cls"), "keys").join(classes.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])

    def shared(self) -> DataFrame:
        """(token, cls, n, pos, at, parities) of the prefix tokens that two classes share; ``at`` is the
        place of the class's first line. Tokens of one class only go by a table of bits before they are shuffled."""
        tokens = self.classes.select(F.explode("prefix").alias("token"))
        often = written(tokens.groupBy("token").count().filter("count > 1"), "line-tokens")
        total = self.classes.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
        least = max(LEAST_COMMON, total / COMMON_SHARE)
        common = often.filter(F.col("count") > least)
        cell = F.shiftrightunsigned("token", 64 - CELL_BITS).alias("cell")
        level = F.floor(F.log2(F.max("count") / F.lit(float(least)))).cast("int").alias("level")
        marked = {row["cell"]: row["level"] for row in common.groupBy(cell).agg(level).collect()}  # fewer than COMMON_SHARE
        hashes = often.select(F.xxhash64("token").alias("h"))
        classes = self.classes.drop("last")
        if marked:
            table = bytes(LEVELS[min(marked[k], len(LEVELS) - 1)] if k in marked else RARE[0] for k in range(1 << CELL_BITS))
            changed = F.exists("prefix", lambda k: _mark(k, table) != F.lit(RARE))
            again = written(classes.filter(changed).drop("prefix"), "line-again")
            prefix = _prefix(_common_last(F.col("keys"), table), self.percent).alias("prefix")
            anew = written(again.join(self._sets(again, "line-again").select("cls", prefix), "cls"), "line-anew")
            classes = classes.filter(~changed).unionByName(anew)
            hashes = hashes.union(anew.select(F.explode("prefix").alias("token")).select(F.xxhash64("token")))
        marks = _marks(hashes, TOKEN_BITS, "line-shared")
        postings = classes.select("cls", F.posexplode("prefix").alias("pos", "token"))
        met = written(postings.filter(_marked(F.xxhash64("token"), marks, TOKEN_BITS)), "line-met")
        several = met.groupBy("token").count().filter("count > 1").select("token")
        return met.join(several, "token").join(classes.drop("prefix"), "cls")

    def _verified(self, met: DataFrame, name: str) -> DataFrame:
        """Of pairs (x, y: postings) the classes x that are similar to their y."""
        side = lambda a, b: F.struct(f"{a}.cls", f"{a}.at").alias(b)
        pairs = written(met.select(side("x", "a"), side("y", "b")).distinct(), "line-pairs")
        held = pairs.select("a.*").union(pairs.select("b.*")).dropDuplicates(["cls"])
        sets = written(self._sets(written(held, "line-held"), name), "line-sets")
        keys = lambda a: sets.select(F.col("cls").alias(a), F.col("keys").alias(f"keys_{a}"))
        both = pairs.select(F.col("a.cls").alias("a"), F.col("b.cls").alias("b")).join(keys("a"), "a").join(keys("b"), "b")
        similar = both.filter(_similar(self.percent, F.size(F.array_intersect("keys_a", "keys_b")), F.size("keys_a"), F.size("keys_b")))
        return written(similar.select(F.col("a").alias("cls")).distinct(), "line-similar")

    def later(self) -> DataFrame:
        """Classes whose first line has a similar line before it.

        Each class is held first against the earliest class that shares one of its prefix tokens, which
        settles nearly all of a group of near copies in a number of pairs that grows with the
        group; classes not settled so are then held against all earlier ones.
        """
        shared = written(self.shared(), "line-shared")
        first = F.min(F.struct("at", "cls", "n", "pos", *PARITY)).alias("first")
        earliest = shared.groupBy("token").agg(first).select("token", "first.*")
        same, before = F.col("x.token") == F.col("y.token"), F.struct("y.at", "y.cls") < F.struct("x.at", "x.cls")
        near = _close(self.percent, "x", "y")
        found = self._verified(shared.alias("x").join(earliest.alias("y"), same & before & near), "line-first")
        rest = shared.join(found, "cls", "left_anti")
        more = self._verified(rest.alias("x").join(shared.alias("y"), same & before & near), "line-more")
        return found.union(more)


def repeated_lines(docs: DataFrame, percent: int = 80, shingle: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, version, line) of the lines, counted from 0, that go: those whose token set has a
    Jaccard similarity of ``percent`` or more with that of an earlier line of any document.

    Earlier is by doc_id (null first), line number and then a hash of the text. Lines without words
    stay. Rows with the same id and text are one document, so repeated rows lose the same lines; rows
    without an id are documents of their own, and the lines given for them are those of the first of
    each text (``with_copies`` tells which rows are further copies). Null and empty texts have none. Only the named columns are read; an empty table gives no rows.
    ``version`` is the hash of the text.
    """
    lines = _Lines(docs, percent, shingle, doc_id, text)
    place = F.struct("doc_id", "line", "version")
    copied = lines.classes.filter("at <> last").select("cls", F.col("at").alias("first"))
    later = lines.later().withColumn("later", F.lit(True))
    which = copied.join(later, "cls", "full_outer")
    return (
        lines.lines.select("doc_id", "version", "line", "cls")
        .join(which, "cls")
        .filter(F.coalesce("later", F.lit(False)) | (place != F.col("first")))
        .select("doc_id", "version", "line")
        .distinct()
    )


def dedup_lines(docs: DataFrame, percent: int = 80, shingle: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines that ``repeated_lines`` finds cut from their texts. Every row and column
    stays; a text that loses all lines is empty."""
    gone = repeated_lines(docs, percent, shingle, doc_id, text)
    rows = with_copies(docs, doc_id, text)
    by_text = gone.groupBy(F.col("doc_id").alias("gone_id"), F.col("version").alias("gone_version")).agg(F.collect_set("line").alias("gone_lines"))
    body = rows[text].cast("string")
    same = rows[doc_id].cast("long").eqNullSafe(by_text["gone_id"]) & (F.xxhash64(body) == by_text["gone_version"])
    gone_lines = by_text["gone_lines"]
    kept = F.array_join(F.filter(F.split(body, "\n", -1), lambda _, k: ~F.array_contains(gone_lines, k)), "\n")
    wordless = F.array_join(F.filter(F.split(body, "\n", -1), lambda x: ~x.rlike(WORDED)), "\n")
    cut = F.when(rows[COPY], wordless).when(gone_lines.isNull(), body).otherwise(kept)
    return rows.join(by_text, same, "left").select(*(cut.alias(text) if c == text else rows[c] for c in docs.columns))
