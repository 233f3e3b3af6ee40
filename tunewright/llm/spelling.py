"""Spelling variants: words one edit apart, found by rotations of their letters around a terminator."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunewright.llm.common import prepare, release, staged

RUN = r"[A-Za-zÀ-ÿ]"
SHORTEST = 7
FEWEST = 2
RATIO = 10
#: One (document, word) of so many has a letter deleted before words are counted.
DAMAGED = 31
#: Stands before the first letter in rotations; it is never a letter.
END = "$"
#: Rotations of more letters are known by their length, cut and a polynomial instead of their text.
SPELLED = 64
#: Fixed value: a prime; the polynomial of a rotation is taken modulo it.
PRIME = (1 << 127) - 1
BASE = 0x5DEECE66D1234567890ABCDEF1234567
#: Rows of one output batch.
ROWS = 50_000


def words(documents: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z lower-cased, that occur often enough.

    Of a run whose crc32 with its document's key is divisible by 31 one letter is deleted, at every
    occurrence in that document. Shorter runs cannot become words and are never taken out of a text.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    run = F.translate(F.col("run"), upper, upper.lower())
    runs = documents.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{shortest},}}"), F.lit(0))).alias("run"),
    ).select("doc", run.alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % DAMAGED == 0, damaged).otherwise(F.col("run"))
    return (
        hashed.select(word.alias("word")).where(F.length("word") >= shortest)
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= fewest)
    )


def _spelled(numbered: DataFrame) -> DataFrame:
    """All rotations of short words: in full, and without their last letter, which is the edited one.

    A word a + c + b has the rotation b $ a c; skipping c it is b $ a, which is also the rotation in
    full of the word a + b. `part`: 0 for a rotation in full; 2 where c is skipped; 1 where c is
    skipped and the letter after it is the same, so that deleting either gives one word.
    """
    size, at = F.length("word"), F.col("at")
    in_full = at <= size
    before = F.when(in_full, at).otherwise(at - size - 1)
    after = F.when(in_full, at).otherwise(at - size)
    key = F.concat(F.substring(F.col("word"), after + 1, size), F.lit(END), F.substring(F.col("word"), F.lit(1), before))
    repeated = F.substring(F.col("word"), after, F.lit(1)) == F.substring(F.col("word"), after + 1, F.lit(1))
    part = F.when(in_full, 0).when(repeated, 1).otherwise(2)
    return numbered.withColumn("at", F.explode(F.sequence(F.lit(0), 2 * size))).select(key.alias("key"), part.alias("part"), "id", "n")


def rotations(word: str):
    """(key, part) of a word as above; keys of many letters are short all the same."""
    size = len(word)
    sums, powers = [0], [1]
    for c in word:
        sums.append((sums[-1] * BASE + ord(c)) % PRIME)
        powers.append(powers[-1] * BASE % PRIME)

    def key(after: int, before: int) -> str:
        """The rotation of what comes from `after` on, the terminator and the first `before` letters."""
        letters = size - after + before
        if letters <= SPELLED:
            return f"{word[after:]}{END}{word[:before]}"
        tail = (sums[size] - sums[after] * powers[size - after]) % PRIME
        return f"{END}{letters}.{before}.{(sums[before] * powers[size - after] + tail) % PRIME:x}"

    for i in range(size + 1):
        yield key(i, i), 0
    for i in range(size):
        yield key(i + 1, i), 1 if word[i : i + 1] == word[i + 1 : i + 2] else 2


def _long_rotations(batches):
    for batch in batches:
        rows = []
        for word, number, n in zip(*(c.to_pylist() for c in batch.columns)):
            for key, part in rotations(word):
                rows.append((key, part, number, n))
                if len(rows) == ROWS:
                    yield _rotation_rows(rows)
                    rows = []
        yield _rotation_rows(rows)


def _rotation_rows(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "part", "id", "n"])


def near_words(numbered: DataFrame) -> DataFrame:
    """(id, n_near, best) of the words (id, word, n) that are one edit from another; best is (n, -id).

    Rotations are sorted by the key that skips the edited letter; equal keys are a group, which holds
    a word per letter of the alphabet and one more at most, whatever the corpus. A scan of the group gives
    each member its number of neighbours there and the best of them; pairs are not written out. Two
    words meet in one group only, so the groups of a word add up. ids are in order of the words.
    """
    short = _spelled(numbered.where(F.length("word") <= SPELLED))
    long = numbered.where(F.length("word") > SPELLED).select("word", "id", "n").mapInArrow(_long_rotations, "key string, part int, id long, n long")
    group = Window.partitionBy("key")
    ranked = group.orderBy(F.col("part") == 0, F.desc("n"), "id")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    worth = F.struct("n", (-F.col("id")).alias("id"))
    skips = F.col("part") > 0
    scanned = (
        short.unionByName(long)
        .withColumn("rows", F.count("*").over(group))
        .where("rows > 1")
        .withColumn("worth", worth)
        .withColumn("skips", F.count_if(skips).over(group))
        .withColumn("edits", F.count_if(F.col("part") == 2).over(group))
        .withColumn("shorter", F.max(F.when(~skips, F.col("worth"))).over(group))
        .withColumn("longer", F.max(F.when(F.col("part") == 2, F.col("worth"))).over(group))
        .withColumn("top", F.first("worth").over(whole))
        .withColumn("next", F.lead(F.when(skips, F.col("worth"))).over(ranked))
    )
    other = F.when(F.col("worth") == F.col("top"), F.col("next")).otherwise(F.col("top"))
    deleted = F.when(F.col("part") == 2, F.col("shorter"))
    met = scanned.select(
        "id",
        F.when(~skips, F.col("edits")).otherwise(F.col("skips") - 1 + deleted.isNotNull().cast("long")).alias("near"),
        F.when(~skips, F.col("longer")).otherwise(F.greatest(deleted, other)).alias("best"),
    ).where("near > 0")
    return met.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(id, root) of links (id, form): the last id that forms lead to. Each round doubles the steps taken."""
    now = staged(forms.select("id", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        onward = now.select(F.col("id").alias("root"), F.col("root").alias("onward"))
        then = staged(now.join(onward, "root", "left").select("id", F.coalesce("onward", "root").alias("root")), "roots")
        release(now)
        now = then
    return now


def variants(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, fewest: int = FEWEST, ratio: int = RATIO
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of a corpus.

    Words are runs of letters of at least `shortest` code points that occur `fewest` times. Near words
    differ by one inserted, deleted or replaced code point; n_near counts them. The form of a word is
    its near word of largest n, ties by code points, if that n is `ratio` times the word's; root is
    where forms lead in the end, the word itself if it has none. Null and empty texts have no words;
    repeated rows count each time; a null key is like the empty text; an empty table gives an empty one;
    extra columns are not read. A word of any length is only rotated by reference: its rotations are
    hashed to 127 bits where they are longer than 64 letters.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or forms may lead in a circle")
    prepare(documents.sparkSession)
    counted = staged(words(documents, key, text, shortest, fewest), "words")
    # numbers in order of the words, so that ties are compared by number
    numbered = staged(
        counted.repartitionByRange("word").sortWithinPartitions("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "numbered"
    )
    most = counted.agg(F.max("n")).first()[0] or 1
    release(counted)
    near = staged(
        near_words(numbered).select("id", "n_near", F.col("best.n").alias("form_n"), (-F.col("best.id")).alias("form")), "near"
    )
    named = numbered.join(near, "id", "left")
    has_form = F.col("form_n") >= ratio * F.col("n")
    named = staged(
        named.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("form")).alias("form"), F.when(has_form, F.col("form_n")).alias("form_n"),
        ),
        "named",
    )
    release(near, numbered)
    chain = max(1, math.floor(math.log(most, ratio)) + 1)  # each step is `ratio` times as frequent
    links = roots(named.where("form IS NOT NULL"), math.ceil(math.log2(chain)))
    texts = named.select(F.col("id").alias("to"), F.col("word").alias("said"))
    spelled = (
        named.where("form IS NOT NULL").select("id", "form").join(links, "id")
        .join(texts.withColumnsRenamed({"to": "form", "said": "form_word"}), "form")
        .join(texts.withColumnsRenamed({"to": "root", "said": "root_word"}), "root")
        .select("id", "form_word", "root_word")
    )
    return named.join(spelled, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
