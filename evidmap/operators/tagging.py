"""Dictionary tagging (E3): treatments, outcomes, their effect and the population, from whole texts.

All terms and cues are one automaton (Aho-Corasick). It is built once, broadcast, and every text
passes it once, whatever the number of terms. A dictionary beyond ``part_chars`` characters is cut
by the first words of its terms: each part passes the texts by itself, and what is found meets by
text.

The effect is read by a fold over what is found in a clause, from left to right; see ``TagRules``.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidmap.schemas import EXTRACTED

# What a term or cue is; cues are read together, longest first.
TREATMENT, OUTCOME, GOOD, BAD, RISE, FALL, NEUTRAL, NEGATOR, BREAK = range(9)
DESIGN, FEMALE, MALE, AGE, STAGE, SPECIAL = range(9, 15)
CUES = (GOOD, BAD, RISE, FALL, NEUTRAL, NEGATOR, BREAK)
WHOLE_TEXT = (DESIGN, FEMALE, MALE)  # may reach over the end of a sentence
NAMED = (TREATMENT, OUTCOME, AGE, STAGE, SPECIAL)


@dataclass(frozen=True)
class TagRules:
    """What the tagger looks for; terms map to the name they are reported under.

    Terms and cues are matched as whole words in lower-case text in which every run of other
    characters than letters and digits is one blank. Where terms of a kind overlap, the first and
    then the longest one counts; cues count as one kind.

    With ``scoped``, effects are read clause by clause; ``breaks`` and the end of a sentence end a
    clause. Cues belong to the outcomes after them, up to the next cue behind an outcome; those
    behind the last outcome belong to it as well. In a clause that begins with an outcome they
    belong to the outcomes before them instead ("pain was reduced"). A rise is good for ``wanted``
    outcomes and bad for ``unwanted`` ones, a fall the other way round. A cue within
    ``scope`` words behind a negator shows no effect. A clause without treatments takes those of
    the clause before (at the beginning: of the sentence). Directions of a pair in several clauses
    that contradict each other become ``mixed``. Without ``scoped`` all cues of a sentence belong
    to all its pairs, a fall is good, a rise bad, and each direction of a pair is a row.
    """

    # Treatments and outcomes the extraction task names as examples.
    treatments: dict[str, str] = field(
        default_factory=lambda: {
            "dienogest": "dienogest",
            "gnrh agonist": "GnRH agonist",
            "gnrh agonists": "GnRH agonist",
            "laparoscopic surgery": "laparoscopic surgery",
            "laparoscopy": "laparoscopic surgery",
            "placebo": "placebo",
        }
    )
    outcomes: dict[str, str] = field(
        default_factory=lambda: {
            "dysmenorrhea": "dysmenorrhea",
            "dysmenorrhea severity": "dysmenorrhea severity",
            "fertility": "fertility outcomes",
            "fertility outcomes": "fertility outcomes",
            "pelvic pain": "pelvic pain",
            "pelvic pain reduction": "pelvic pain reduction",
            "pregnancy rate": "pregnancy rate",
            "recurrence": "recurrence rate",
            "recurrence rate": "recurrence rate",
        }
    )
    # Cue words of the effect directions.
    positive: Sequence[str] = ("benefit", "effective", "improved", "relieved")
    negative: Sequence[str] = ("adverse", "harm", "increased risk", "worse", "worsened")
    neutral: Sequence[str] = (
        "no difference",
        "no significant difference",
        "no significant effect",
        "not significantly",
    )
    rises: Sequence[str] = ("elevated", "higher", "increased", "raised")
    falls: Sequence[str] = ("decreased", "lower", "lowered", "reduced")
    # Outcomes, by the names they are reported under, of which more is better or worse.
    wanted: Sequence[str] = ("fertility outcomes", "pelvic pain reduction", "pregnancy rate")
    unwanted: Sequence[str] = (
        "dysmenorrhea",
        "dysmenorrhea severity",
        "pelvic pain",
        "recurrence rate",
    )
    negators: Sequence[str] = ("did not", "failed to", "never", "no", "not", "without")
    breaks: Sequence[str] = ("although", "but", "however", "whereas", "while")
    scope: int = 3
    # Phrases of the study designs, first design that occurs wins.
    designs: Sequence[tuple[str, Sequence[str]]] = (
        ("meta_analysis", ("meta analysis", "metaanalysis")),
        ("systematic_review", ("systematic review",)),
        ("randomized_controlled_trial", ("randomized", "randomised", "rct")),
        ("case_control", ("case control",)),
        ("cohort_study", ("cohort",)),
        ("cross_sectional", ("cross sectional",)),
        ("case_report", ("case report", "case series")),
        ("narrative_review", ("review",)),
    )
    # Words of the study subjects; female words first.
    female: Sequence[str] = ("women", "woman", "female", "females")
    male: Sequence[str] = ("men", "man", "male", "males")
    subjects: Sequence[str] = ("women", "men", "patients", "participants", "subjects")
    # Further fields of the population; the first one that occurs wins.
    age_groups: dict[str, str] = field(
        default_factory=lambda: {
            "adolescent": "adolescents",
            "adolescents": "adolescents",
            "teenagers": "adolescents",
            "adult": "adults",
            "adults": "adults",
            "reproductive age": "reproductive age",
            "reproductive aged": "reproductive age",
            "perimenopausal": "perimenopausal",
            "postmenopausal": "postmenopausal",
        }
    )
    stages: dict[str, str] = field(
        default_factory=lambda: {
            **{f"stage {n}": n.upper() for n in ("i", "ii", "iii", "iv")},
            **{f"stage {n}": r for n, r in (("1", "I"), ("2", "II"), ("3", "III"), ("4", "IV"))},
            **{f"stages {a} {b}": f"{a.upper()}-{b.upper()}" for a, b in (("i", "ii"), ("iii", "iv"))},
            **{f"stage {a} {b}": f"{a.upper()}-{b.upper()}" for a, b in (("i", "ii"), ("iii", "iv"))},
            "minimal to mild": "I-II",
            "moderate to severe": "III-IV",
        }
    )
    special_populations: dict[str, str] = field(
        default_factory=lambda: {
            "infertile": "infertile",
            "infertility": "infertile",
            "obese": "obese",
            "pregnant": "pregnant",
        }
    )
    scoped: bool = True
    part_chars: int = 50_000_000

    def entries(self) -> Iterator[tuple[str, int, str]]:
        """(term, kind, name) of everything that is looked for."""
        named = (
            (TREATMENT, self.treatments),
            (OUTCOME, self.outcomes),
            (AGE, self.age_groups),
            (STAGE, self.stages),
            (SPECIAL, self.special_populations),
        )
        for kind, names in named:
            yield from ((term, kind, name) for term, name in names.items())
        plain = (
            (GOOD, self.positive),
            (BAD, self.negative),
            (RISE, self.rises),
            (FALL, self.falls),
            (NEUTRAL, self.neutral),
            (NEGATOR, self.negators),
            (BREAK, self.breaks),
            (FEMALE, self.female),
            (MALE, self.male),
        )
        for kind, words in plain:
            yield from ((word, kind, word) for word in words)
        for name, phrases in self.designs:
            yield from ((phrase, DESIGN, name) for phrase in phrases)

    def check(self) -> None:
        for word in (*(term for term, _, _ in self.entries()), *self.subjects):
            if " ".join(re.findall(r"[^\W_]+", word.lower())) != word:
                raise ValueError(f"not in lower-case words between single blanks: {word!r}")


# All cues of a sentence belong to all its pairs; no words but those that are given.
NO_SCOPE = {
    "scoped": False,
    **dict.fromkeys(("rises", "falls", "negators", "breaks"), ()),
    **{fields: {} for fields in ("age_groups", "stages", "special_populations")},
}

_SENTENCE_END = r"[.!?]+(?:\s+|$)|[\r\n]+"


def plain_sentences(text: Column) -> Column:
    """Lower-case words between single blanks, sentences between line ends."""
    lines = F.regexp_replace(F.lower(text), _SENTENCE_END, "\n")
    # most runs are one blank, which stays
    return F.regexp_replace(lines, r"[^\p{L}\p{N}\n ][^\p{L}\p{N}\n]*| [^\p{L}\p{N}\n]+", " ")


# ---- the automaton ---------------------------------------------------------------


def automata(entries: Iterable[tuple[str, int, str]], part_chars: int) -> list[ahocorasick.Automaton]:
    """One automaton; several, cut by first word, beyond ``part_chars`` characters of terms."""
    meanings: dict[str, list[tuple[int, str]]] = {}
    for term, kind, name in entries:
        if (kind, name) not in meanings.setdefault(term, []):
            meanings[term].append((kind, name))
    number = max(1, math.ceil(sum(map(len, meanings)) / part_chars))
    parts = [ahocorasick.Automaton() for _ in range(number)]
    for term, own in meanings.items():
        parts[zlib.crc32(term.split(" ", 1)[0].encode()) % number].add_word(f" {term} ", (len(term), own))
    parts = [part for part in parts if len(part)]
    for part in parts:
        part.make_automaton()
    return parts


class Hit(NamedTuple):
    start: int  # of its first character in the text
    end: int
    kind: int
    name: str


def joined(plain: str) -> tuple[str, list[int]]:
    """The sentences one behind the other, between blanks, and where each begins."""
    sentences = [s for s in (line.strip(" ") for line in plain.split("\n")) if s]
    begins, at = [], 1
    for sentence in sentences:
        begins.append(at)
        at += len(sentence) + 1
    return " " + " ".join(sentences) + " " if sentences else " ", begins


def hits_of(text: str, part: ahocorasick.Automaton) -> Iterator[Hit]:
    hit = Hit._make
    for end, (length, own) in part.iter(text):
        for kind, name in own:
            yield hit((end - length, end, kind, name))


# ---- reading what is found -------------------------------------------------------


def _taken(hits: Iterable[Hit]) -> list[Hit]:
    """Hits that do not overlap: the first, then the longest."""
    hits = list(hits)
    if len(hits) < 2:
        return hits
    found, end = [], 0
    for hit in sorted(hits, key=lambda h: (h.start, -h.end, h.name)):
        if hit.start >= end:
            found.append(hit)
            end = hit.end
    return found


def _distinct(names: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(names))


def _owners(tokens: list[Hit]) -> dict[Hit, list[Hit]]:
    """The cues that belong to each outcome of a clause."""
    follow = tokens[0].kind == OUTCOME  # the clause begins with an outcome
    owned: dict[Hit, list[Hit]] = {}
    waiting: list[Hit] = []
    group: list[Hit] = []
    last_outcomes: list[Hit] = []
    for token in tokens:
        if token.kind == OUTCOME:
            if follow and group:
                owned |= dict.fromkeys(waiting, group)
                waiting, last_outcomes, group = [], waiting, []
            waiting.append(token)
        else:
            if not follow and waiting:
                owned |= dict.fromkeys(waiting, group)
                waiting, last_outcomes, group = [], waiting, []
            group.append(token)
    if follow:
        # outcomes behind the last cue go with the ones before it
        cues = group or (owned[last_outcomes[0]] if last_outcomes else [])
        return owned | dict.fromkeys(waiting, cues)
    if waiting:
        return owned | dict.fromkeys(waiting, group)
    # cues behind the last outcome
    return owned | {o: owned[o] + group for o in last_outcomes}


def _direction(effects: set[int | None]) -> str:
    if 0 in effects:
        return "neutral"
    if {1, -1} <= effects:
        return "mixed"
    return "positive" if 1 in effects else "negative" if -1 in effects else "unknown"


def _clauses(tokens: list[Hit]) -> Iterator[list[Hit]]:
    clause: list[Hit] = []
    for token in tokens:
        if token.kind == BREAK:
            yield clause
            clause = []
        else:
            clause.append(token)
    yield clause


def scoped_pairs(text: str, tokens: list[Hit], rules: TagRules) -> Iterator[tuple[str, str, str]]:
    """(treatment, outcome, direction) of a sentence, clause by clause."""
    worth = dict.fromkeys(rules.wanted, 1) | dict.fromkeys(rules.unwanted, -1)
    before = [t.name for t in tokens if t.kind == TREATMENT]
    for clause in _clauses(tokens):
        own = [t.name for t in clause if t.kind == TREATMENT]
        before = treatments = own or before
        negated, negator = set(), None
        for token in clause:
            if token.kind == NEGATOR:
                negator = token
            elif token.kind in (GOOD, BAD, RISE, FALL) and negator:
                # words between the two
                if text.count(" ", negator.end, token.start) - 1 < rules.scope:
                    negated.add(token)
        told = [t for t in clause if t.kind in (OUTCOME, GOOD, BAD, RISE, FALL, NEUTRAL)]
        if not any(t.kind == OUTCOME for t in told):
            continue

        def effect(cue: Hit, outcome: str) -> int | None:
            if cue.kind == NEUTRAL or cue in negated:
                return 0
            if cue.kind in (GOOD, BAD):
                return 1 if cue.kind == GOOD else -1
            sign = worth.get(outcome)
            return sign and (sign if cue.kind == RISE else -sign)

        for outcome, cues in _owners(told).items():
            direction = _direction({effect(cue, outcome.name) for cue in cues})
            yield from ((t, outcome.name, direction) for t in treatments)


def sentence_pairs(tokens: list[Hit]) -> Iterator[tuple[str, str, str]]:
    """(treatment, outcome, direction) of a sentence whose cues belong to all its pairs."""
    sign = {NEUTRAL: 0, GOOD: 1, FALL: 1, BAD: -1, RISE: -1}
    direction = _direction({sign.get(t.kind) for t in tokens})
    outcomes = _distinct(t.name for t in tokens if t.kind == OUTCOME)
    for treatment in _distinct(t.name for t in tokens if t.kind == TREATMENT):
        yield from ((treatment, outcome, direction) for outcome in outcomes)


def _folded(pairs: Iterable[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """One direction per pair; known ones that contradict each other are mixed."""
    told: dict[tuple[str, str], set[str]] = {}
    for treatment, outcome, direction in pairs:
        told.setdefault((treatment, outcome), set()).add(direction)
    found = []
    for pair, directions in told.items():
        known = directions - {"unknown"}
        found.append((*pair, "mixed" if len(known) > 1 else next(iter(known), "unknown")))
    return found


def read(text: str, begins: list[int], hits: Iterable[Hit], rules: TagRules, sample: re.Pattern) -> tuple:
    """The fields of an extraction, from the hits in a text."""
    sentences: dict[int, dict[int, list[Hit]]] = {}
    whole: dict[int, set[str]] = {}
    stops = [*begins[1:], math.inf]
    for hit in hits:
        start, end, kind, name = hit
        if kind in WHOLE_TEXT:
            whole.setdefault(kind, set()).add(name)
            continue
        number = bisect_right(begins, start) - 1
        if end < stops[number]:
            sentences.setdefault(number, {}).setdefault(kind, []).append(hit)
    treatments, outcomes, pairs, fields = [], [], [], {}
    for number in sorted(sentences):
        own = sentences[number]
        named = {k: _taken(own.get(k, ())) for k in NAMED}
        treatments += [h.name for h in named[TREATMENT]]
        outcomes += [h.name for h in named[OUTCOME]]
        for kind in (AGE, STAGE, SPECIAL):
            if named[kind]:
                fields.setdefault(kind, named[kind][0].name)
        if named[TREATMENT] and named[OUTCOME]:
            cues = [h for k in CUES for h in own.get(k, ())]
            if rules.scoped:
                cues = _taken(cues)
            tokens = sorted(named[TREATMENT] + named[OUTCOME] + cues)
            pairs += scoped_pairs(text, tokens, rules) if rules.scoped else sentence_pairs(tokens)
    pairs = _folded(pairs) if rules.scoped else list(dict.fromkeys(pairs))
    treatments, outcomes = _distinct(treatments), _distinct(outcomes)
    designs = whole.get(DESIGN, ())
    design = next((name for name, _ in rules.designs if name in designs), "unknown")
    size = sample.search(text)
    digits = size[1].lstrip("0") or "0" if size else ""
    # a number that no int holds is not a sample size
    size = int(digits) if digits and len(digits) < 11 and int(digits) < 1 << 31 else None
    population = {
        "sex": "female" if FEMALE in whole else "male" if MALE in whole else None,
        "age_group": fields.get(AGE),
        "disease_stage": fields.get(STAGE),
        "sample_size": size,
        "special_population": fields.get(SPECIAL),
    }
    told = [{"treatment": t, "outcome": o, "effect_direction": d} for t, o, d in pairs]
    # share of the four kinds of findings that are there
    confidence = sum(map(bool, (treatments, outcomes, pairs, design != "unknown"))) / 4
    return treatments, outcomes, told, design, population, confidence


_NAMES = pa.list_(pa.string())
_ROW = {
    "treatments": _NAMES,
    "outcomes": _NAMES,
    "treatment_outcomes": pa.list_(
        pa.struct([("treatment", pa.string()), ("outcome", pa.string()), ("effect_direction", pa.string())])
    ),
    "study_design": pa.string(),
    "population": pa.struct(
        [("sex", pa.string()), ("age_group", pa.string()), ("disease_stage", pa.string()),
         ("sample_size", pa.int32()), ("special_population", pa.string())]
    ),
    "extraction_confidence": pa.float64(),
}


def tag_abstracts(abstracts: DataFrame, rules: TagRules | None = None) -> DataFrame:
    """Extraction rows (no time) of (pubmed_id, abstract), found by dictionary in whole texts."""
    rules = rules or TagRules()
    rules.check()
    plain = abstracts.select("pubmed_id", plain_sentences(F.col("abstract")).alias("plain"))
    context = abstracts.sparkSession.sparkContext
    parts = [context.broadcast(part) for part in automata(rules.entries(), rules.part_chars)]
    sample = re.compile(rf" (\d+) (?:{'|'.join(rules.subjects)}) ", re.ASCII)
    # the dictionary itself travels by broadcast
    small = TagRules(**{f: getattr(rules, f) for f in rules.__dataclass_fields__} | {"treatments": {}, "outcomes": {}})
    if len(parts) > 1:
        plain = _with_hits(plain, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("hits").to_pylist() if len(parts) > 1 else [None] * len(batch)
            rows = []
            for line, hits in zip(batch.column("plain").to_pylist(), given):
                text, begins = joined(line or "")
                if hits is not None:
                    hits = [Hit(*h.values()) for h in hits]
                else:
                    hits = hits_of(text, parts[0].value) if parts else ()
                rows.append(read(text, begins, hits, small, sample))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _ROW.values())]
            yield pa.RecordBatch.from_arrays([batch.column("pubmed_id"), *columns], ["pubmed_id", *_ROW])

    found = plain.mapInArrow(run, f"pubmed_id string, {EXTRACTED}")
    return found.withColumn("extraction_error", F.lit(None).cast("string"))


_HITS = "array<struct<start:int,end:int,kind:int,name:string>>"


def _with_hits(plain: DataFrame, parts: list) -> DataFrame:
    """``plain`` with ``hits``: each part of the dictionary passes the texts by itself."""
    keyed = plain.withColumn("key", F.sha2("plain", 256))
    texts = keyed.select("key", "plain").dropDuplicates(["key"])

    def passed(part) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(
                pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("name", pa.string())])
            )
            for batch in batches:
                hits = [
                    [h._asdict() for h in hits_of(joined(line or "")[0], part.value)]
                    for line in batch.column("plain").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(hits, kind)], ["key", "hits"])

        return texts.mapInArrow(run, f"key string, hits {_HITS}")

    found = reduce(DataFrame.unionByName, [passed(part) for part in parts]).where(F.size("hits") > 0)
    found = found.groupBy("key").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    return keyed.join(found, "key", "left").select(
        "pubmed_id", "plain", F.coalesce("hits", F.array().cast(_HITS)).alias("hits")
    )
