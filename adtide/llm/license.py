"""License scans: TF-IDF cosine of lines to templates, then inheritance from the nearest directory.

Templates are statements, titles, standard headers, title blocks of long licences and whole short ones. A file's
lines, and its runs of as many words as a template has, wherever lines end, are compared with them as sparse TF-IDF
vectors. Document frequencies are those of the template words over all lines of the table; any other word weighs as
one seen once. A part at or above the threshold states the license of its template if it has the words that tell this
license from its neighbours, an SPDX tag states the license it names, and a file's license is that of its most similar
part. A file without a statement inherits from the nearest directory above it, on the same host, that has a licence
file with one. A licence file has a usual name or is the directory's own page, whose path ends in a slash. All
directories above a file are exploded and joined by path, so that a hot directory is a join key like any other.

Defined results: null and empty texts state nothing; a null or empty url has no directory and inherits
nothing; of several statements the most similar wins, then the first template, of several files of a directory
the most similar, then the smallest id; repeated rows repeat; an empty table gives no rows; other columns are ignored;
texts of any length are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.llm import license_texts
from adtide.llm.common import store

#: Statements by which a license is usually declared.
TEMPLATES = license_texts.STATEMENTS
THRESHOLD = 0.7
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.-][^/]*)?$"
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_TAG = re.compile(r"<[^>]*>")
_LINE = re.compile(r"[\n\r]+|(?<=[.;!?])\s+(?=[A-Z&(])")

_SHORT = re.compile(r"(?<=[gm]pl)v?-?(?=[0-9])")
#: Tokens that are written in several ways.
_SAME = {"licence": "license", "licenced": "licensed", "licences": "licenses", "v1.0": "1", "v2": "2", "v3": "3", "v2.1": "2.1", "1.0": "1", "2.0": "2", "3.0": "3", "4.0": "4", "v2.0": "2", "v3.0": "3", "v4.0": "4"}
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*(\(*[A-Za-z0-9.+-]+\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9.+-]+\)*)*)", re.I)


def tokens(text: str) -> list[str]:
    low = text.lower()
    if "gpl" in low or "mpl" in low:
        low = _SHORT.sub(" ", low)
    same = _SAME.get
    return [same(w, w) for w in _WORD.findall(low)]


@dataclass(frozen=True)
class Template:
    """A text of a licence; ``runs`` if every run of as many words is compared with it, ``single`` if every line is."""

    name: str
    words: Counter
    length: int
    runs: bool
    single: bool
    needed: tuple[frozenset[str], ...]
    foreign: frozenset[str]

    def allows(self, words) -> bool:
        return all(any(w in words for w in group) for group in self.needed) and not any(w in words for w in self.foreign)


def _template(name: str, text: str, runs: bool, single: bool) -> Template:
    words = tokens(text)
    needed = tuple(map(frozenset, license_texts.NEEDED[name]))
    return Template(name, Counter(words), len(words), runs, single, needed, frozenset(license_texts.FOREIGN.get(name, ())))


_TEMPLATES = [_template(n, t, True, True) for n, t in [*TEMPLATES.items(), *license_texts.MORE]]
_TEMPLATES += [_template(n, t, True, False) for n, t in license_texts.PASSAGES] + [_template(n, t, False, True) for n, t in license_texts.TITLES]
VOCABULARY = sorted(set().union(*(t.words for t in _TEMPLATES)))


def lines(text: str) -> list[str]:
    """Lines and sentences of a text, tags taken for line ends."""
    plain = _TAG.sub("\n", text) if "<" in text else text
    return [line for line in _LINE.split(plain) if line and not line.isspace()]


def _frequencies(files: DataFrame) -> dict[str, int]:
    """Number of lines (under '') and of lines with each template word, over the whole table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = set(VOCABULARY), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for line in lines(text or ""):
                    seen[""] += 1
                    seen.update(wanted.intersection(tokens(line)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    counted = files.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # at most one row for each word of the templates
    return {r["word"]: r["n"] for r in counted.collect()}


_IDS = {name.lower(): name for name in license_texts.SPDX_IDS}
_LATER = re.compile(r"(?i)(-only|-or-later|\+)$")


def _is_operand(word: str, after: str) -> bool:
    """Whether a word of an SPDX expression names a licence, or an exception after WITH."""
    plain = word.strip("()")
    if after.upper() == "WITH":
        return "exception" in plain.lower() or plain.lower().startswith("additionref-")
    return plain.lower().startswith("licenseref-") or _LATER.sub("", plain).lower() in _IDS


def spdx(text: str) -> str | None:
    """The first SPDX tag of a text that states licences, without a suffix for later versions if it is a single one.

    Every operand must be a known identifier or a LicenseRef; a sentence about tags or a pointer to a file
    states nothing.
    """
    for found in _SPDX.finditer(text):
        words = found[1].strip().rstrip(".").split()
        # a sentence may go on after a single licence as if it were an expression
        if not all(_is_operand(word, words[at - 1] if at else "") for at, word in enumerate(words) if at % 2 == 0):
            continue
        if len(words) > 1:
            return " ".join(words)
        plain = words[0].strip("()")
        return _IDS.get(_LATER.sub("", plain).lower(), plain)
    return None


class Matcher:
    """Cosines of lines and of runs of words to the templates under given weights."""

    def __init__(self, idf: dict[str, float], rare: float, threshold: float = THRESHOLD):
        self.idf, self.rare, self.threshold = idf, rare, threshold
        self.vectors = [{w: c * idf[w] for w, c in t.words.items()} for t in _TEMPLATES]
        self.norms = [math.sqrt(sum(x * x for x in v.values())) for v in self.vectors]

    def _possible(self, present: set[str]) -> list[int]:
        """Templates that any part of a text with these words can reach, by Cauchy-Schwarz; nothing else is left out."""
        found = []
        for at, t in enumerate(_TEMPLATES):
            if all(not group.isdisjoint(present) for group in t.needed):
                shared = math.sqrt(sum(x * x for w, x in self.vectors[at].items() if w in present))
                if shared >= (self.threshold - 1e-9) * self.norms[at]:
                    found.append(at)
        return found

    def _line(self, at: int, words: Counter) -> float:
        if not _TEMPLATES[at].allows(words):
            return 0.0
        own = {w: c * self.idf.get(w, self.rare) for w, c in words.items()}
        norm = math.sqrt(sum(x * x for x in own.values()))
        return sum(x * own[w] for w, x in self.vectors[at].items() if w in own) / (norm * self.norms[at])

    def _runs(self, at: int, words: list[str]) -> float:
        """Best cosine of the runs of as many words as the template has, or of all words if they are fewer."""
        template, vector = _TEMPLATES[at], self.vectors[at]
        size, best = min(template.length, len(words)), 0.0
        counts: Counter = Counter()
        square = dot = 0.0
        for end, word in enumerate(words, 1):
            weight = self.idf.get(word, self.rare)
            square += weight * weight * (2 * counts[word] + 1)
            counts[word] += 1
            dot += weight * vector.get(word, 0.0)
            if end > size:
                old = words[end - size - 1]
                weight = self.idf.get(old, self.rare)
                counts[old] -= 1
                square -= weight * weight * (2 * counts[old] + 1)
                dot -= weight * vector.get(old, 0.0)
                if not counts[old]:
                    del counts[old]
            if end >= size and dot > best * math.sqrt(square) * self.norms[at] + 1e-9 and template.allows(counts):
                best = dot / (math.sqrt(square) * self.norms[at])
        return min(best, 1.0)

    def best(self, text: str) -> tuple[str | None, float]:
        """Licence and cosine, or null and 0 where no template can reach the threshold."""
        plain = _TAG.sub("\n", text) if "<" in text else text
        tagged = spdx(text)
        if tagged:
            return tagged, 1.0
        words = tokens(plain)
        possible = self._possible(set(words))
        if not possible:
            return None, 0.0
        singles = [Counter(tokens(line)) for line in lines(text)]
        name, best = None, 0.0
        for at in possible:
            score = self._runs(at, words) if _TEMPLATES[at].runs else 0.0
            if _TEMPLATES[at].single:
                score = max([score, *(self._line(at, single) for single in singles if single)])
            if score > best + 1e-9:
                name, best = _TEMPLATES[at].name, score
        return name, best


def best_template(text: str, idf: dict[str, float], rare: float) -> tuple[str | None, float]:
    return Matcher(idf, rare).best(text)


def scan(files: DataFrame, id_column: str, url_column: str, text_column: str, threshold: float = THRESHOLD) -> DataFrame:
    """id, license, score, origin (``own``, ``inherited`` or null), declared_by of every file."""
    base = files.select(F.col(id_column).cast("long").alias("id"), F.col(url_column).alias("url"), F.col(text_column).alias("text"))
    counts = _frequencies(base)
    total = counts.get("", 0)
    idf = {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1 for w in VOCABULARY}
    rare = math.log((1 + total) / 2) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(idf, rare, threshold)
        for batch in batches:
            found = [matcher.best(t or "") for t in batch.column(2).to_pylist()]
            names = [n if s >= threshold else None for n, s in found]
            scores = [s if s >= threshold else None for _, s in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["id", "url", "own", "score"])

    scanned = base.mapInArrow(run, "id long, url string, own string, score double")
    path = F.regexp_replace(F.regexp_replace("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://", ""), r"[?#].*$", "")
    scanned = store(scanned.withColumn("path", F.coalesce(path, F.lit(""))).withColumn("row", F.monotonically_increasing_id()), "scanned")
    folder = F.regexp_replace("path", r"/[^/]*$", "/")
    is_file = F.col("path").rlike(LICENCE_FILE) | F.col("path").endswith("/")
    stated = scanned.where("own is not null and path like '%/%'").where(is_file)
    folders = stated.groupBy(folder.alias("dir")).agg(F.min_by(F.struct("own", "score", "id"), F.struct(-F.col("score"), "id")).alias("by"))
    seeking = scanned.where("own is null and path like '%/%'")
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))
    steps = seeking.select("row", F.explode(above).alias("dir"))
    inherited = steps.join(folders, "dir").groupBy("row").agg(F.max_by("by", F.length("dir")).alias("by"))
    joined = scanned.join(inherited, "row", "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("by").isNotNull(), "inherited")
    return joined.select("id", F.coalesce("own", "by.own").alias("license"), F.coalesce("score", "by.score").alias("score"), origin.alias("origin"), F.when(F.col("own").isNotNull(), F.col("id")).otherwise(F.col("by.id")).alias("declared_by"))
