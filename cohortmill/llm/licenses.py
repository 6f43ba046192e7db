"""License scans by template-markup matching.

Words are runs of a-z, 0-9 and non-ASCII characters after A-Z are lowered. A template is
compiled into a token automaton: a mandatory word is a state that only this word leaves, an
optional region can be skipped, a replaceable one takes a bounded number of any words, and a
guard lets nothing pass if one of its words comes next. A
place is accepted if the automaton reaches its end, so the mandatory wording matches exactly;
of the ends of one place the last counts. The automaton's states are the bits of one number
and it runs from the places of its first word, in texts that hold the template's longest
mandatory run. Short phrases are also found by themselves, wherever they stand.

Defined cases: null and empty texts have no words, places or labels. Places may overlap; a
place is reported for each template and phrase. Repeated rows each get their result.
Columns that the operator doesn't name are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.common import mapped, texts
from cohortmill.llm.license_templates import TEMPLATES

# Phrases and the labels they give.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
PHRASE_SCORE = 0.5

FOUND = (
    "doc_id bigint, n_words bigint, phrases array<struct<label:string,start:bigint>>, "
    "templates array<struct<label:string,name:string,start:bigint,end:bigint>>"
)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_MARK = re.compile(r"<<(begin|end|var (\d+)-(\d+)|unless ([a-z0-9 ]+))>>")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def parse(markup: str) -> list:
    """Words as bytes, replaceable regions as (least, most), optional regions as lists, guards as sets."""
    stack: list[list] = [[]]
    at = 0
    for mark in _MARK.finditer(markup):
        stack[-1] += words_of(markup[at : mark.start()].encode())
        at = mark.end()
        if mark[1] == "begin":
            stack.append([])
        elif mark[1] == "end":
            region = stack.pop()
            stack[-1].append(region)
        elif mark[4]:
            stack[-1].append(frozenset(mark[4].encode().split()))
        else:
            stack[-1].append((int(mark[2]), int(mark[3])))
    stack[-1] += words_of(markup[at:].encode())
    if len(stack) != 1:
        raise ValueError("an optional region has no end")
    return stack[0]


class Automaton:
    """States are bits; state i is left by its word or by any, and may be passed without one."""

    def __init__(self, parts: list):
        self.words: dict[bytes, int] = {}
        self.any = 0
        self.passes: list[tuple[int, int, frozenset]] = []
        self.end = 0
        self._add(parts)
        self.passes.sort(key=lambda p: p[:2])
        if not parts or not isinstance(parts[0], bytes):
            raise ValueError("a template begins with a mandatory word")
        self.first = parts[0]
        runs, run = [], []
        for part in [*parts, None]:
            if isinstance(part, bytes):
                run.append(part)
            else:
                runs.append(run)
                run = []
        self.mandatory = b" " + b" ".join(max(runs, key=len)) + b" "

    def _add(self, parts: list) -> None:
        for part in parts:
            begin = self.end
            if isinstance(part, bytes):
                self.words[part] = self.words.get(part, 0) | 1 << self.end
                self.end += 1
            elif isinstance(part, tuple):
                least, most = part
                self.any |= ((1 << most) - 1) << self.end
                self.end += most
                self.passes += [(begin + n, self.end, frozenset()) for n in range(least, most)]
            elif isinstance(part, frozenset):
                self.end += 1
                self.passes.append((begin, self.end, part))
            else:
                self._add(part)
                self.passes.append((begin, self.end, frozenset()))

    def run(self, words: list[bytes], start: int) -> int | None:
        """Where the last match that begins at `start` ends, if there is one."""
        last, state = None, self._passed(1, words[start])
        for i in range(start, len(words)):
            following = words[i + 1] if i + 1 < len(words) else b""
            state = self._passed((state & (self.words.get(words[i], 0) | self.any)) << 1, following)
            if not state:
                break
            if state >> self.end & 1:
                last = i + 1
        return last

    def _passed(self, state: int, following: bytes) -> int:
        for source, target, refused in self.passes:
            if state >> source & 1 and following not in refused:
                state |= 1 << target
        return state


def compiled(templates=TEMPLATES) -> list[tuple[str, str, Automaton]]:
    return [(label, name, Automaton(parse(markup))) for label, name, markup in templates]


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers where `phrase`, with a space at both ends, stands in `joined`."""
    found, at, number, counted = [], joined.find(phrase), 0, 0
    while at >= 0:
        number += joined.count(b" ", counted, at)
        counted = at
        found.append(number)
        at = joined.find(phrase, at + 1)
    return found


def find(text: bytes, automata: list[tuple[str, str, Automaton]]) -> tuple[int, list[dict], list[dict]]:
    """Number of words, phrases and accepted templates of one text."""
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    phrases = [
        {"label": label, "start": start}
        for phrase, label in PHRASES.items()
        for start in places(joined, f" {phrase} ".encode())
    ]
    accepted = []
    for label, name, automaton in automata:
        if automaton.mandatory in joined:
            for start in places(joined, b" " + automaton.first + b" "):
                if (end := automaton.run(words, start)) is not None:
                    accepted.append({"label": label, "name": name, "start": start, "end": end})
    return len(words), phrases, accepted


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES) -> DataFrame:
    """(doc_id, n_words, phrases, templates) of each row; places count words from 0, ends are exclusive."""
    automata = compiled(templates)
    phrase_kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    template_kind = pa.list_(
        pa.struct([("label", pa.string()), ("name", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    )

    def work(batch: pa.RecordBatch) -> dict:
        found = [find(t, automata) for t in texts(batch["text"]).cast(pa.large_binary()).to_pylist()]
        n_words, phrases, accepted = zip(*found)
        return {
            "doc_id": batch["doc_id"],
            "n_words": pa.array(n_words, pa.int64()),
            "phrases": pa.array(phrases, phrase_kind),
            "templates": pa.array(accepted, template_kind),
        }

    needed = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return mapped(needed, work, FOUND)


def labelled(found: DataFrame) -> DataFrame:
    """Labels and score: 1 with an accepted template, less with a phrase alone."""
    by_phrase = F.array_sort(F.array_distinct(F.transform("phrases", lambda p: p["label"])))
    by_template = F.transform("templates", lambda t: t["label"])
    return (
        found.withColumn("base_labels", F.array_join(by_phrase, ","))
        .withColumn("labels", F.array_join(F.array_sort(F.array_union(by_phrase, by_template)), ","))
        .withColumn(
            "score",
            F.when(F.size("templates") > 0, 1.0).when(F.size("phrases") > 0, PHRASE_SCORE).otherwise(0.0),
        )
    )
