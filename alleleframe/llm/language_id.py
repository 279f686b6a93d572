"""Language ID by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary have a probability in each language. A
word is a sequence of pieces in many ways; its probability is the sum over all
of them, which a forward algorithm gives without listing any. A text is scored
by the sum of the logarithms over its words plus that of the language's share of
the documents, and the language with the largest sum is predicted.

Words are the maximal runs of letters and numerals (decimal digits and ``_``
apart), in lower case, with the vocabulary's mark of a beginning before them; a
run of more than ``LONGEST`` characters is scored as several words. A character
that is no piece is one unknown piece, which has a probability too.

The probabilities are learned by expectation-maximisation: counted words of the
learning documents are spread over tasks, each gives expected piece counts by
forward and backward sums, and a round ends with the sums of these, one row per
piece and language. Learning uses at most ``PER_LANGUAGE`` documents of each of
the ``LANGUAGES`` most frequent languages: those that have the smallest
hashes of id and text. Held-out rows (crc32 of the id as text, modulo 4, is 2) are never
learned from; language, source and id are no inputs of a prediction.

Scoring needs no shuffle: the table of probabilities is as large as vocabulary
times languages, whatever the data, and each task scores each word it meets once.

Nulls and special rows: a text that is null or has no letter is ``und`` with a
score of 0, and so is every text where nothing could be learned. A null lang is
never learned from; a null ``doc_id`` is an empty id, which is not held out. Rows
that repeat an id are all predicted, and learned from like others. Ties go to
the language whose name sorts first. Long texts are read in pieces. Other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.llm.arrays import small_parts
from alleleframe.llm.common import staged, table, whole_text

VOCABULARY = "piece_bpe_32k.model"
#: Learning documents of a language, and languages, at most.
PER_LANGUAGE = 600
LANGUAGES = 64
OVERSHOT = 8
ROUNDS = 4
#: Characters of a word, and of a piece, at most. Sums of so many pieces at the floor stay above zero.
LONGEST = 32
FLOOR = 1e-8
#: What a piece has in every language before anything is counted.
PRIOR = 0.05
#: Numbers held for the words of one forward pass.
HELD = 1 << 22
#: Words that a task remembers.
REMEMBERED = 1 << 18
PIECE = 1 << 20
UNKNOWN = "und"
_BEGIN = "▁"


def vocabulary(path: str) -> list[str]:
    """The text pieces of a vocabulary; its control, unknown and byte pieces are left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return sorted({p for p in found if len(p) <= LONGEST})


_WORD = re.compile(r"[^\W\d_]+")
_GAP = re.compile(r"[\W\d_]")


def words_of(text: str):
    """Lists of the words of a text, each from a piece of bounded size."""
    begin = 0
    while begin < len(text):
        end = len(text)
        if end - begin > PIECE:
            gap = _GAP.search(text, begin + PIECE)
            end = gap.end() if gap else end
        found = _WORD.findall(text[begin:end].lower())
        if any(len(w) > LONGEST for w in found):
            found = [w[i : i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]
        yield found
        begin = end


def lattice(words: list[str], number: dict[str, int]) -> tuple[np.ndarray, ...]:
    """Edges (word, start, end, piece) of all segmentations, and the word lengths, marks included."""
    longest, unknown = max(map(len, number), default=1), len(number)
    get = number.get
    word, start, end, piece = [], [], [], []
    for w, text in enumerate(words):
        text = _BEGIN + text
        n = len(text)
        for i in range(n):
            single = True
            for j in range(i + 1, min(n, i + longest) + 1):
                found = get(text[i:j])
                if found is not None:
                    single = single and j > i + 1
                    word.append(w)
                    start.append(i)
                    end.append(j)
                    piece.append(found)
            if single:
                word.append(w)
                start.append(i)
                end.append(i + 1)
                piece.append(unknown)
    return (*(np.array(x, np.int32) for x in (word, start, end, piece)), np.array([len(w) + 1 for w in words], np.int32))


def forward(edges: tuple, chances: np.ndarray) -> np.ndarray:
    """alpha[word, place, language]: the probability of all segmentations up to a place."""
    word, start, end, piece, lengths = edges
    alpha = np.zeros((len(lengths), int(lengths.max()) + 1, chances.shape[1]))
    alpha[:, 0] = 1
    order = np.lexsort((word, end))
    cuts = np.searchsorted(end[order], np.arange(1, alpha.shape[1] + 1))
    for place, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True), 1):
        some = order[a:b]
        if len(some):
            parts = alpha[word[some], start[some]] * chances[piece[some]]
            first = np.flatnonzero(np.append(True, word[some][1:] != word[some][:-1]))
            alpha[word[some[first]], place] = np.add.reduceat(parts, first)
    return alpha


def backward(edges: tuple, chances: np.ndarray) -> np.ndarray:
    """beta[word, place, language]: the probability of all segmentations from a place on."""
    word, start, end, piece, lengths = edges
    beta = np.zeros((len(lengths), int(lengths.max()) + 1, chances.shape[1]))
    beta[np.arange(len(lengths)), lengths] = 1
    order = np.lexsort((word, start))
    cuts = np.searchsorted(start[order], np.arange(beta.shape[1] + 1))
    for place in range(beta.shape[1] - 1, -1, -1):
        some = order[cuts[place] : cuts[place + 1]]
        if len(some):
            parts = beta[word[some], end[some]] * chances[piece[some]]
            first = np.flatnonzero(np.append(True, word[some][1:] != word[some][:-1]))
            beta[word[some[first]], place] = np.add.reduceat(parts, first)
    return beta


def word_logs(words: list[str], number: dict[str, int], chances: np.ndarray) -> np.ndarray:
    """Logarithms of the probabilities of some words in every language."""
    found = np.empty((len(words), chances.shape[1]))
    step = max(16, HELD // (chances.shape[1] * (LONGEST + 2)))
    for i in range(0, len(words), step):
        edges = lattice(words[i : i + step], number)
        alpha = forward(edges, chances)
        found[i : i + step] = np.log(alpha[np.arange(len(edges[4])), edges[4]])
    return found


def expected_counts(words: list[str], counts: np.ndarray, number: dict[str, int], chances: np.ndarray) -> np.ndarray:
    """Expected occurrences of every piece, the unknown one last, in words with ``counts`` per language."""
    found = np.zeros_like(chances)
    step = max(16, HELD // (chances.shape[1] * (LONGEST + 2)))
    for i in range(0, len(words), step):
        edges = lattice(words[i : i + step], number)
        word, start, end, piece, lengths = edges
        alpha, beta = forward(edges, chances), backward(edges, chances)
        whole = alpha[np.arange(len(lengths)), lengths]
        share = alpha[word, start] * chances[piece] * beta[word, end] / whole[word] * counts[i : i + step][word]
        for k in range(chances.shape[1]):
            found[:, k] += np.bincount(piece, share[:, k], minlength=len(found))
    return found


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def learning_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """lang, text of the learning documents; hashes decide, so no text is sorted or moved.

    Only rows with hashes so small that a language is expected to have
    ``OVERSHOT`` times as many as are taken are ranked: a bounded number, however
    many there are. A row's copies share its hash and are all learned from.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    hashed = known.select("lang", "text", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1).alias("hash"))
    names = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    bound = F.lit(2.0**63) * OVERSHOT * per_language / F.col("n")
    small = hashed.join(F.broadcast(names), "lang").where(F.col("hash") < bound).select("lang", "hash").distinct()
    order = Window.partitionBy("lang").orderBy("hash")
    taken = small.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
    # At most LANGUAGES * per_language pairs, so every executor can hold them.
    taken = F.broadcast(taken.select("lang", "hash"))
    return hashed.join(taken, ["lang", "hash"], "left_semi").select("lang", F.col("text").cast("string").alias("text"))


def counted_words(rows: DataFrame) -> DataFrame:
    """lang, word, n: how often each word occurs in the texts of a language."""
    schema = "lang string, word string, n long"

    def count(batches):
        for whole in batches:
            for batch in small_parts(whole):
                found: dict[tuple[str, str], int] = {}
                langs, texts = (batch.column(c).to_pylist() for c in ("lang", "text"))
                for lang, text in zip(langs, texts, strict=True):
                    for words in words_of(text):
                        for word in words:
                            found[lang, word] = found.get((lang, word), 0) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in found], pa.string()),
                        pa.array([k[1] for k in found], pa.string()),
                        pa.array(list(found.values()), pa.int64()),
                    ],
                    names=["lang", "word", "n"],
                )

    parts = rows.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(count, schema)
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order, their shares, and the probability of each piece in each language."""

    def __init__(self, pieces: list[str], languages: list[str], shares: np.ndarray, chances: np.ndarray):
        self.pieces, self.languages, self.shares, self.chances = pieces, languages, shares, chances


def train(docs: DataFrame, pieces: list[str], per_language: int = PER_LANGUAGE, rounds: int = ROUNDS) -> Model:
    """Piece probabilities from the rows of ``docs`` that have a language and are not held out."""
    spark = docs.sparkSession
    rows = learning_rows(docs.select("doc_id", "text", "lang"), per_language)
    words = staged(counted_words(rows), "language-words")
    known = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    # One row per language kept: at most LANGUAGES.
    learned = words.groupBy("lang").agg(F.count("*").alias("n"))
    shares = known.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count("*").alias("docs"))
    found = learned.join(shares, "lang").select("lang", "docs").orderBy("lang").collect()
    languages = [r.lang for r in found]
    share = np.array([r.docs for r in found], float)
    n, k = len(pieces) + 1, len(languages)
    chances = np.full((n, max(k, 1)), 1 / n)
    if not languages:
        return Model(pieces, [], share, chances)
    place = {lang: i for i, lang in enumerate(languages)}
    by_word = staged(
        words.groupBy("word").agg(F.collect_list(F.struct("lang", "n")).alias("counts")), "language-lists"
    )

    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((pieces, chances))

        def expect(batches):
            pieces, chances = sent.value
            number = {p: i for i, p in enumerate(pieces)}
            total = np.zeros_like(chances)
            for batch in batches:
                words, lists = (batch.column(c).to_pylist() for c in ("word", "counts"))
                counts = np.zeros((len(words), chances.shape[1]))
                for i, some in enumerate(lists):
                    for entry in some:
                        counts[i, place[entry["lang"]]] = entry["n"]
                if words:
                    total += expected_counts(words, counts, number, chances)
            used, language = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array(language, pa.int64()), pa.array(total[used, language])],
                names=["piece", "language", "n"],
            )

        parts = by_word.mapInArrow(expect, "piece long, language long, n double")
        # At most a row per piece and language, whatever the data.
        sums = parts.groupBy("piece", "language").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full((n, k), PRIOR)
        counts[sums["piece"].to_numpy(int), sums["language"].to_numpy(int)] += sums["n"].to_numpy(float)
        chances = np.maximum(counts / counts.sum(axis=0), FLOOR)
        chances /= chances.sum(axis=0)
    return Model(pieces, languages, share / share.sum(), chances)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score: the language of every whole text and its probability among the learned ones."""
    rows = docs.select("doc_id", whole_text().alias("text"))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.pieces, model.languages, model.shares, model.chances)
    )

    def score(batches):
        pieces, languages, shares, chances = sent.value
        number = {p: i for i, p in enumerate(pieces)}
        known: dict[str, int] = {}
        logs = np.zeros((0, len(languages)))

        def numbers(words):
            for w in words:
                if w not in known:
                    known[w] = len(known)
            return np.fromiter(map(known.__getitem__, words), np.int32, len(words))

        for batch in (part for whole in batches for part in small_parts(whole)):
            texts = batch.column("text").to_pylist()
            if len(known) > REMEMBERED:
                known, logs = {}, logs[:0]
            ids = [[numbers(words) for words in words_of(t)] for t in texts] if languages else []
            fresh = list(known)[len(logs) :]
            if fresh:
                logs = np.concatenate([logs, word_logs(fresh, number, chances)])
            names, scores = [], []
            for i, text in enumerate(texts):
                if not languages or not any(map(str.isalpha, text)):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = np.log(shares)
                for some in ids[i]:
                    for a in range(0, len(some), 1 << 16):
                        total = total + logs[some[a : a + (1 << 16)]].sum(axis=0)
                best = int(total.argmax())
                names.append(languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=schema.names,
            )

    return rows.mapInArrow(score, schema)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, vocabulary(public_tokenizers.path(VOCABULARY)))
    found = predicted(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
