"""Spelling variants of words by permuterm rotations.

A word and a terminator are rotated to every place: `abc$` gives `abc$`, `bc$a`, `c$ab` and
`$abc`. If the character that an edit touches comes last, the rest of the rotation is what the
two words share: words that differ by a replacement there have the same rotation but for its
last character, and the word without that character has just the rest as a rotation. So each
rotation is put under the prefix that skips its last character and, as a word that lacks a
character, under itself; the rotations are sorted, and a scan of the groups of equal prefixes
finds for every member the best other one and how many there are.

A group holds one word for each character of the alphabet at most and one without it, so its
size does not grow with the data, and no pairs are emitted. A deletion from a run of equal
characters (`aab`, `ab`) meets in a group per character of the run; it counts in the first.

Defined cases: null and empty texts have no words. Rows that share a doc_id, and repeated rows,
are texts of their own whose occurrences add up. A word without a near word has n_near 0 and is
its own root. Ties between forms go to the smaller word in code-point order. An empty table
gives an empty one. Other columns of the documents are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import byte_values
from riskloom.session import materialize

LETTERS = "a-zÀ-ÿ"
TERMINATOR = "$"
HELD = 400_000


def word_counts(
    docs: DataFrame,
    min_chars: int,
    least: int,
    altered: Callable[[str, str], str] | None = None,
    letters: str = LETTERS,
) -> DataFrame:
    """word, n: runs of letters (A-Z lower-cased) that have so many code points and occur so
    often. altered(doc_id, word), applied in the tasks, gives the word that is counted instead.
    """
    pattern = re.compile(f"[{letters}]{{{min_chars},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                names=["word", "n"],
            )
            found.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_values(batch.column(1))):
                own = pattern.findall((text or b"").lower().decode("utf-8", "replace"))
                if altered is None:
                    found.update(own)
                    continue
                for word, n in Counter(own).items():
                    word = altered(doc_id, word)
                    if len(word) >= min_chars:
                        found[word] += n
                if len(found) > HELD:
                    yield out()
        yield out()

    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id")
    parts = docs.select(ids, "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """rest, word, n, skips, first: a row per rotation as a whole and, where it ends in a
    character of the word, one for what is left without that character."""
    size = F.length("word")
    turned = words.withColumn("j", F.explode(F.sequence(F.lit(0), 2 * size)))
    turned = turned.withColumn("skips", F.col("j") > size)
    at = F.when(F.col("skips"), F.col("j") - size - 1).otherwise(F.col("j"))
    turned = turned.withColumn("at", at).withColumn("skip", F.col("skips").cast("int"))
    before = F.substring("word", F.lit(1), F.col("at"))
    after = F.substring("word", F.col("at") + F.col("skip") + 1, size)
    edited = F.substring("word", F.col("at") + 1, F.lit(1))
    previous = F.substring("word", F.col("at"), F.lit(1))
    return turned.select(
        F.concat(after, F.lit(TERMINATOR), before).alias("rest"),
        "word",
        "n",
        "skips",
        (F.col("skips") & ((F.col("at") == 0) | (edited != previous))).alias("first"),
    )


def neighbours(words: DataFrame) -> DataFrame:
    """word, n, n_near and best (minus_n, word): near words differ by exactly one character."""
    rank = F.struct((-F.col("n")).alias("minus_n"), F.col("word"))
    ranked = rotations(words).withColumn("rank", rank)
    group = (
        Window.partitionBy("rest")
        .orderBy("rank")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    scanned = ranked.withColumns(
        {
            "members": F.count(F.lit(1)).over(group),
            "skipping": F.count_if("skips").over(group),
            "deletions": F.count_if("first").over(group),
            "top": F.first("rank").over(group),
            "second": F.nth_value("rank", 2).over(group),
        }
    ).where("members > 1")
    shorter = F.when(F.col("first"), F.col("members") - F.col("skipping")).otherwise(F.lit(0))
    found = scanned.select(
        "word",
        "n",
        F.when(F.col("skips"), F.col("skipping") - 1 + shorter)
        .otherwise(F.col("deletions"))
        .alias("near"),
        F.when(F.col("top")["word"] == F.col("word"), F.col("second"))
        .otherwise(F.col("top"))
        .alias("other"),
    )
    alone = words.select("word", "n", F.lit(0).cast("long").alias("near")).withColumn(
        "other", F.lit(None).cast(found.schema["other"].dataType)
    )
    return (
        found.union(alone)
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("other").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root: from each word along its forms to the last one.

    Each round doubles the steps taken. A form occurs `ratio` times as often as its word, so a
    chain is short whatever the corpus is.
    """
    state = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = materialize(
            state.select("word", "root")
            .join(further, "root", "left")
            .select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "spelling-roots",
        )
        if state.where("moved").isEmpty():
            return state.select("word", "root")


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of counted words.

    form: the near word with the largest n, if that is ratio times the word's at least.
    """
    if ratio < 2:
        raise ValueError("ratio has to be 2 or more, else forms may go round in circles")
    near = neighbours(materialize(words, "spelling-words"))
    best = -F.col("best")["minus_n"]
    led = best >= ratio * F.col("n")
    near = materialize(
        near.select(
            "word",
            "n",
            "n_near",
            F.when(led, F.col("best")["word"]).alias("form"),
            F.when(led, best).alias("form_n"),
        ),
        "spelling-near",
    )
    last = roots(near.where("form IS NOT NULL"))
    return near.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
