"""Subject areas of documents from weak labelling functions.

Two things are learned from rated documents: a lexicon of words that go with
one subject alone, and the notices, passages that the same words make up in
many of them. Every document is then read once, without its notices: for each
subject, in how many lines it is spoken of, with how many different words, in
names or only beside them, and how much of all subject matter that is (body);
whether its address speaks of it; where it comes from; what raters said. Each
of these four is a labelling function; a latent model learns how far each can
be trusted from all documents (expectation maximisation over the counts of
vote patterns) and gives the posterior of every subject.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import prod

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.session import materialize

#: Rated documents the lexicon and the notices are learned from at most (chosen by hash), and words of the lexicon at most.
MAX_RATED, MAX_LEXICON = 300_000, 50_000
#: A word belongs to a subject if this share of the rated documents that keep using it have it, beyond chance.
WORD_SHARE, WORD_EVIDENCE, WORD_DOCUMENTS = 0.75, 15.0, 3
#: A word is shared with a second subject whose documents use it at this part of the first one's rate or more, and in
#: more documents than RATER_ERROR of the first one's and so many deviations of chance explain.
SHARED_RATE, RATER_ERROR, SHARED_DEVIATIONS = 0.15, 0.02, 2.5
#: So many words in a row that so many different rated documents have (this share, and a number) are a notice.
NOTICE_WORDS, NOTICE_SHARE, NOTICE_DOCUMENTS = 10, 0.005, 5
#: How often raters are held to be wrong.
RATER_ERRORS = 0.05
POSTERIOR, EM_ROUNDS = 0.5, 200

_any_words = re.compile(r"[A-Z]?[^\W\d_A-Z]{2,}|[A-Z]{2,}(?![a-z])")
_ascii_words = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}(?![a-z])")
_BLOB = re.compile(r"[A-Za-z0-9+/=_-]{80,}")
_PART = re.compile(r"[\n\r;]+")
_COMMENT_LINE = re.compile(r"\s*(//|#|/?\*|--|<!--|\"\"\"|%)")
_INLINE = re.compile(r"//.*|/\*.*|\s#\s.*|\s--\s.*|<!--.*")
_STRING = re.compile(r"\"([^\"\n]*)\"|'([^'\n]*)'|`([^`\n]*)`")
_VOWEL = re.compile(r"(?<=.)[aeiou]")


def _pattern(text: str) -> re.Pattern[str]:
    return _ascii_words if text.isascii() else _any_words


def _cut(text: str) -> list[str]:
    return _pattern(text).findall(text)


def words_of(text: str) -> list[str]:
    """The lower-case words of a text; parts of joined names are words of their own."""
    return [w.lower() for w in _cut(text)]


# --- notices ------------------------------------------------------------------------
class Codes(dict):
    """A number per word, the same in every task."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word.lower()) >> 1
        return code


def passages(words: list[str], codes: Codes, n: int = NOTICE_WORDS) -> np.ndarray:
    """A number for every run of ``n`` words; none where there are fewer."""
    if len(words) < n:
        return np.zeros(0, np.int64)
    own = np.fromiter(map(codes.__getitem__, words), np.int64, len(words)).view(np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + own[k : k + len(out)]
    return out.view(np.int64)


def without_notices(text: str, words: list[str], notices: np.ndarray, codes: Codes) -> str:
    """The text with every run of words that makes up a notice blotted out."""
    found = passages(words, codes)
    if not len(notices) or not len(found):
        return text
    at = np.searchsorted(notices, found)
    hit = np.flatnonzero(notices[np.minimum(at, len(notices) - 1)] == found)
    if not len(hit):
        return text
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, hit, 1)
    np.add.at(covered, hit + NOTICE_WORDS, -1)
    inside = np.cumsum(covered)[:-1] > 0
    out, last, previous = [], 0, False
    for match, now in zip(_pattern(text).finditer(text), inside):
        if now and not previous:
            out.append(text[last : match.start()])
        if now:
            last = match.end()
        previous = bool(now)
    return " ".join([*out, text[last:]])


# --- the lexicon --------------------------------------------------------------------
def short_forms(word: str) -> set[str]:
    """What a long word may be cut to: without its inner vowels, or its beginning."""
    if len(word) < 5:
        return set()
    forms = {word[:k] for k in range(4, len(word))}
    bare = _VOWEL.sub("", word)
    return forms | ({bare} if len(bare) >= 3 else set())


class Lexicon:
    """The subject of a word, also of one run together with another (``mergedqueue``)."""

    def __init__(self, subjects: dict[str, str]):
        self.subjects = subjects
        self.parts = {w: s for w, s in subjects.items() if len(w) >= 5}
        self.longest = max(map(len, self.parts), default=0)
        self.met: dict[str, str | None] = {}

    def get(self, word: str) -> str | None:
        if word in self.met:
            return self.met[word]
        if len(self.met) > 200_000:
            self.met.clear()
        found = self.subjects.get(word)
        if found is None and len(word) >= 8:
            reach = min(self.longest, len(word) - 3)
            lengths = range(reach, 4, -1)  # the longest ending first, then the longest beginning
            found = next((s for k in lengths if (s := self.parts.get(word[-k:]))), None) or next((s for k in lengths if (s := self.parts.get(word[:k]))), None)
        self.met[word] = found
        return found


def document_votes(text: str, address: str, lexicon: Lexicon, notices: np.ndarray, codes: Codes) -> dict[str, list[int]]:
    """subject -> [lines with it in names, in comments, in strings, times in the address, lines, different words].

    Lines end at semicolons too, so that minified code has lines; runs of
    encoded data and notices are left out.
    """
    votes: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0, 0, 0])
    get = lexicon.get
    for w in words_of(address):
        if s := get(w):
            votes[s][3] += 1
    text = _BLOB.sub(" ", text)
    words = _cut(text)
    if not any(get(w.lower()) for w in set(words)):
        return votes
    clean = without_notices(text, words, notices, codes)
    spoken = {w: s for w in set(words if clean is text else _cut(clean)) if (s := get(w.lower()))}
    for s in set(spoken.values()):
        votes[s][5] = len({w.lower() for w, x in spoken.items() if x == s})
    subject_of = spoken.get
    for part in _PART.split(clean):
        if not any(w in part for w in spoken):
            continue
        for s in {subject_of(w) for w in _cut(part)} - {None}:
            votes[s][4] += 1
        if _COMMENT_LINE.match(part):
            sections = (("", 0), (part, 1), ("", 2))
        else:
            comment = _INLINE.search(part)
            code, said = (part[: comment.start()], comment.group()) if comment else (part, "")
            quoted = " ".join("".join(q) for q in _STRING.findall(code)) if '"' in code or "'" in code or "`" in code else ""
            sections = ((_STRING.sub(" ", code) if quoted else code, 0), (said, 1), (quoted, 2))
        for section, place in sections:
            if section:
                for s in {subject_of(w) for w in _cut(section)} - {None}:
                    votes[s][place] += 1
    return votes


# --- the latent model ---------------------------------------------------------------
#: Labelling functions: a column of levels each. What depends on the same lines is one function of joint levels.
FUNCTIONS = ("body", "address", "source", "rater")
#: By the task's own words, what this many lines or fewer speak of is said in passing and no subject.
PASSING_LINES = 1
#: From where on the parts of the body have their next level.
LINES, SHARE, VARIETY, NAMES = (3, 4, 6, 9, 14), (0.05, 0.12, 0.25, 0.5, 0.8), (2,), (1,)
#: Sources are told apart by hash.
SOURCE_LEVELS = 64
LEVELS = {"body": prod(len(e) + 1 for e in (LINES, SHARE, VARIETY, NAMES)), "address": 3, "source": SOURCE_LEVELS + 1, "rater": 3}

#: Levels of the body that share their lines, and their lines and share; how many rows the coarser level counts for.
COARSER, LEAN = {"body": (LEVELS["body"] // (len(LINES) + 1), (len(VARIETY) + 1) * (len(NAMES) + 1), 1)}, 4.0


def _level(c: str, edges: tuple[float, ...]) -> Column:
    out = F.lit(0)
    for i, e in enumerate(edges):
        out = F.when(F.col(c) >= e, F.lit(i + 1)).otherwise(out)
    return out


def vote_levels(votes: DataFrame) -> DataFrame:
    """The level each labelling function gives a (document, subject)."""
    body = F.lit(0)
    for c, edges in (("n_lines", LINES), ("share", SHARE), ("n_different", VARIETY), ("n_names", NAMES)):
        body = body * (len(edges) + 1) + _level(c, edges)
    source = F.when(F.col("source").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("source"), F.lit(SOURCE_LEVELS)).cast("int") + 1)
    return votes.select("doc_id", "subject", body.alias("body"), _level("n_address", (1, 2)).alias("address"), source.alias("source"), "rater")


@dataclass
class LatentModel:
    """How likely each level is with and without the subject, up to a factor; ``tables``: function -> (2, levels)."""

    prior: float = 0.5
    tables: dict[str, np.ndarray] = field(default_factory=dict)

    def _fit(self, levels: dict[str, np.ndarray], n: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Tables and prior from the posteriors ``p``, and the posteriors that follow from them."""
        self.prior = float(np.clip((p * n).sum() / max(1e-9, n.sum()), 1e-3, 1 - 1e-3))
        logit = np.full(len(n), np.log(self.prior / (1 - self.prior)))
        for f in FUNCTIONS:
            if f == "rater":
                self.tables[f] = np.array([[1.0, RATER_ERRORS, 1 - RATER_ERRORS], [1.0, 1 - RATER_ERRORS, RATER_ERRORS]])
            else:
                every = np.arange(LEVELS[f])
                q = np.full(LEVELS[f], self.prior)  # how often the subject is there: what few rows tell leans on the coarser level
                for width in COARSER.get(f, (1,)):
                    at = every // width
                    with_it, all_ = (np.bincount(levels[f] // width, w * n, at[-1] + 1)[at] for w in (p, np.ones(len(p))))
                    q = (with_it + LEAN * q) / (all_ + LEAN)
                q = np.clip(q, 1e-6, 1 - 1e-6)
                self.tables[f] = np.stack([q / self.prior, (1 - q) / (1 - self.prior)])
            logit += np.log(self.tables[f][0] / self.tables[f][1])[levels[f]]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    @classmethod
    def learn(cls, patterns: pd.DataFrame, rounds: int = EM_ROUNDS) -> LatentModel:
        """From (levels of FUNCTIONS, n): expectation maximisation to a fixpoint.

        Raters anchor it: the first tables come from what they rated, their
        own trust stays at RATER_ERRORS, and what they did not rate counts in
        all as much as what they did, so it can't carry the model away.
        """
        model = cls()
        n = patterns["n"].to_numpy(float)
        levels = {f: patterns[f].to_numpy(int) for f in FUNCTIONS}
        rated = levels["rater"] > 0
        free = n * ~rated
        weight = np.where(rated, n, free * min(1.0, (n * rated).sum() / max(1.0, free.sum())))
        p = np.where(levels["rater"] == 2, 1 - RATER_ERRORS, RATER_ERRORS)
        p = model._fit(levels, n * rated, p) if rated.any() else p
        for _ in range(rounds):
            new = model._fit(levels, weight, p)
            done = np.abs(new - p).max(initial=0) < 1e-5
            p = new
            if done:
                break
        return model

    def posterior(self) -> Column:
        logit = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for f, table in self.tables.items():
            ratios = [float(x) for x in np.log(table[0] / table[1])]
            logit = logit + F.coalesce(F.try_element_at(F.array(*[F.lit(x) for x in ratios]), F.col(f) + 1), F.lit(0.0))
        return 1 / (1 + F.exp(-logit))


# --- the operator -------------------------------------------------------------------
def _rated_passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every passage of a text with the text's least one, which copies of a text share however they were patched."""
    codes = Codes()
    for frame in batches:
        found = [np.unique(passages(_cut(t), codes)) for t in frame["text"]]
        found = [f for f in found if len(f)]
        least = [np.full(len(f), f[np.argmin(f.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))]) for f in found]
        none = [np.zeros(0, np.int64)]
        yield pd.DataFrame({"passage": np.concatenate(found or none), "least": np.concatenate(least or none)})


def _rated_words(notices: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Codes()
        for frame in batches:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                text = _BLOB.sub(" ", text)
                counts: dict[str, int] = defaultdict(int)
                for w in words_of(without_notices(text, _cut(text), notices, codes)):
                    counts[w] += 1
                rows += [(doc_id, w) for w, n in counts.items() if n >= 2]
            yield pd.DataFrame(rows, columns=["doc_id", "word"])

    return run


def _votes(subjects: dict[str, str], notices: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon, codes = Lexicon(subjects), Codes()
        for frame in batches:
            rows = []
            for doc_id, text, address, source in zip(frame["doc_id"], frame["text"], frame["address"], frame["source"]):
                votes = document_votes(text, address, lexicon, notices, codes)
                total = sum(v[4] for v in votes.values())
                rows += [(doc_id, source, s, *v, v[4] / total if total else 0.0) for s, v in votes.items() if any(v)]
            yield pd.DataFrame(rows, columns=["doc_id", "source", "subject", "n_names", "n_comments", "n_strings", "n_address", "n_lines", "n_different", "share"])

    return run


_VOTES = "doc_id bigint, source string, subject string, n_names int, n_comments int, n_strings int, n_address int, n_lines int, n_different int, share double"


class SubjectModel:
    """Learns from rated documents and assigns subjects to all.

    Null and empty texts, and texts no function votes on, have no subject; a
    subject spoken of in passing only (PASSING_LINES) gets no vote.
    Texts are read whole. Ratings with a null or unknown subject are ignored,
    repeated ones count once; a document rated with several subjects counts in
    equal parts for each in the lexicon.
    """

    def __init__(self, documents: DataFrame, ratings: DataFrame, areas: DataFrame):
        self.documents = documents.where(F.length("text") > 0).select("doc_id", "text", "source", F.concat_ws(" ", "repo_name", "file_path").alias("address"))
        known = ratings.join(F.broadcast(areas.select("subject").distinct()), "subject").where(F.col("doc_id").isNotNull()).select("doc_id", "subject").distinct()
        self.ratings = materialize(known, "subject-ratings")
        per_doc = self.ratings.groupBy("doc_id").agg((1 / F.count(F.lit(1))).alias("weight")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_RATED)
        self.weighted = materialize(self.ratings.join(per_doc, "doc_id"), "subject-weights")

    def _rated_texts(self) -> DataFrame:
        return self.documents.join(self.weighted.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text")

    def learn_notices(self) -> np.ndarray:
        """The passages of notices, sorted: at most the mean words of a text over NOTICE_SHARE of them."""
        n = self.weighted.select("doc_id").distinct().count()
        met = self._rated_texts().select("text").mapInPandas(_rated_passages, "passage bigint, least bigint").groupBy("passage", "least").agg(F.count(F.lit(1)).alias("_n"))
        counts = met.groupBy("passage").agg(F.count(F.lit(1)).alias("n"))  # of texts that are no copies of each other
        often = counts.where(F.col("n") >= max(NOTICE_DOCUMENTS, int(NOTICE_SHARE * n))).select("passage").toPandas()
        return np.sort(often["passage"].to_numpy(np.int64))

    def learn_lexicon(self, notices: np.ndarray) -> dict[str, str]:
        """word -> subject: words that keep to one subject, and short forms of them."""
        single = F.col("weight") == 1
        rated = {r["subject"]: (r["n"], r["alone"]) for r in self.weighted.groupBy("subject").agg(F.sum("weight").alias("n"), F.sum(single.cast("int")).alias("alone")).collect()}
        if not rated:
            return {}
        total = sum(n for n, _ in rated.values())
        words = self._rated_texts().mapInPandas(_rated_words(notices), "doc_id bigint, word string").join(self.weighted, "doc_id")
        words = materialize(words.groupBy("word", "subject").agg(F.sum("weight").alias("n"), F.sum(single.cast("int")).alias("alone")), "subject-words")
        of = F.create_map(*[x for s, (n, alone) in rated.items() for x in (F.lit(s), F.struct(F.lit(n / total).alias("base"), F.lit(float(max(alone, 1))).alias("alone")))])
        uses = F.collect_list(F.struct("subject", "n", "alone", (F.col("alone") / of[F.col("subject")]["alone"]).alias("rate")))
        per_word = words.groupBy("word").agg(F.sum("n").alias("df"), F.max_by("subject", F.struct("n", "subject")).alias("subject"), F.max("n").alias("n"), uses.alias("uses"))
        base, other = of[F.col("subject")]["base"], F.greatest(F.col("df") - F.col("n"), F.lit(0.0))
        evidence = 2 * (F.col("n") * F.log(F.col("n") / F.col("df") / base) + F.when(other > 0, other * F.log(other / F.col("df") / (1 - base))).otherwise(0.0))
        main = F.element_at(F.filter("uses", lambda u: u["subject"] == F.col("subject")), 1)
        by_chance = RATER_ERROR * F.col("n")
        shared = F.exists(
            "uses", lambda u: (u["subject"] != F.col("subject")) & (u["alone"] >= by_chance + SHARED_DEVIATIONS * F.sqrt(by_chance) + 1) & (u["rate"] >= SHARED_RATE * main["rate"])
        )
        good = per_word.where((F.col("n") >= WORD_DOCUMENTS) & (F.col("n") / F.col("df") >= WORD_SHARE) & ~shared).select("word", "subject", evidence.alias("e")).where(F.col("e") >= WORD_EVIDENCE)
        core = {r["word"]: r["subject"] for r in good.orderBy(F.desc("e"), "word").limit(MAX_LEXICON).collect()}
        spark = words.sparkSession
        forms = spark.createDataFrame(sorted({(f, s) for w, s in core.items() for f in short_forms(w)}), "word string, subject string")
        # a short form that is a word of its own must go with the same subject
        met = words.groupBy("word").agg(F.sum("n").alias("df")).where(F.col("df") >= WORD_DOCUMENTS)
        own = words.select("word", "subject", F.col("n").alias("_n"))
        kept = forms.join(met, "word", "left").join(own, ["word", "subject"], "left").where(F.col("df").isNull() | (F.coalesce(F.col("_n"), F.lit(0.0)) / F.col("df") >= 0.5))
        clear = kept.groupBy("word").agg(F.count_distinct("subject").alias("k"), F.first("subject").alias("subject")).where("k = 1")
        return core | {r["word"]: r["subject"] for r in clear.select("word", "subject").collect() if r["word"] not in core}

    def votes(self, lexicon: dict[str, str], notices: np.ndarray) -> DataFrame:
        raw = materialize(self.documents.mapInPandas(_votes(lexicon, notices), _VOTES), "subject-votes")
        said = self.ratings.withColumn("_said", F.lit(True))
        rated = self.ratings.select("doc_id").distinct().withColumn("_rated", F.lit(True))
        joined = raw.where(F.col("n_lines") > PASSING_LINES).join(said, ["doc_id", "subject"], "left").join(rated, "doc_id", "left")
        return vote_levels(joined.withColumn("rater", F.when(F.col("_said"), F.lit(2)).when(F.col("_rated"), F.lit(1)).otherwise(F.lit(0))))

    def posteriors(self) -> DataFrame:
        """(doc_id, subject, posterior) of every subject some function votes for."""
        notices = self.learn_notices()
        levels = materialize(self.votes(self.learn_lexicon(notices), notices), "subject-levels")
        patterns = levels.groupBy(*FUNCTIONS).agg(F.count(F.lit(1)).alias("n")).toPandas()  # as many rows as there are patterns of levels, not documents
        model = LatentModel.learn(patterns) if len(patterns) else LatentModel()
        return levels.select("doc_id", "subject", model.posterior().alias("posterior"))

    def assign(self) -> DataFrame:
        """(doc_id, subject, posterior): the subjects of each document, the two likeliest where more are likely."""
        likely = self.posteriors().where(F.col("posterior") >= POSTERIOR)
        best = likely.groupBy("doc_id").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("posterior", "subject")))), 1, 2).alias("best"))
        return best.select("doc_id", F.inline("best")).select("doc_id", "subject", "posterior")


def subject_shares(assigned: DataFrame, documents: DataFrame) -> DataFrame:
    """(subject, n_documents, share): of all documents; one row for those without subject, null."""
    total = documents.agg(F.count(F.lit(1)).alias("total"))
    rows = documents.select("doc_id").join(assigned.select("doc_id", "subject"), "doc_id", "left").groupBy("subject").agg(F.count(F.lit(1)).alias("n_documents"))
    return rows.join(F.broadcast(total)).select("subject", "n_documents", (F.col("n_documents") / F.col("total")).alias("share"))
