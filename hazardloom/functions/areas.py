"""Areas in warning texts, as table functions: one tokeniser, one stack of open brackets.

``register`` makes them SQL functions, for lateral joins: ``select t.id, s.* from t, lateral parse_signals(t.text) s``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

# How a signal and what describes it begin, heads of island groups (no places of a signal), words of
# directions, how advisories lead up to areas and what their status is then, and what ends the areas.
SIGNAL_WORDS, NUMBER_WORDS = ("tcws", "signal"), ("no", "no.", "number", "#")
NO_SIGNAL = "no tropical cyclone wind signal"
DESCRIBED = [("wind", "threat"), ("warning", "lead", "time"), ("range", "of", "wind", "speeds"), ("potential", "impact"), ("potential", "impacts"), ("beaufort",)]
ISLAND_GROUPS = ("luzon", "visayas", "mindanao")
SIDES = ("north", "south", "east", "west", "central", "northern", "southern", "eastern", "western")
CORNERS = ("northeastern", "northwestern", "southeastern", "southwestern")
BEFORE_SIDES = ("extreme", "central", "mainland")
LEADS = [
    ("is expected over", "expected"), ("are expected over", "expected"),
    ("is being experienced in", "occurring"), ("are being experienced in", "occurring"),
    ("is being experienced over", "occurring"), ("are being experienced over", "occurring"),
    ("is affecting", "occurring"), ("are affecting", "occurring"),
    ("more likely to develop over", "watch"), ("less likely to develop over", "watch"),
]
ENDS = ["within", "which may", "and may", "for the next"]


def _by_first(phrases: list) -> dict[str, list]:
    """Phrases by their first word, in their order, so that a token is compared with few of them."""
    out: dict[str, list] = {}
    for words, *more in phrases:
        out.setdefault(words[0], []).append((words, *more))
    return out


_DESCRIBED = _by_first([(words,) for words in DESCRIBED])
_LEADS = _by_first([(tuple(words.split(" ")), words.split(" ", 1)[1], words.split(" ")[0].upper() if status == "watch" else "", status) for words, status in LEADS])
_ENDS = _by_first([(tuple(words.split(" ")),) for words in ENDS])

_OPEN, _CLOSE = "([", ")]"
_EDGE = " .:–-"
_TOKEN = re.compile(r"\n|[^\S\n]+|[()\[\],;:#]|\d+|[^\s()\[\],;:#\d]+")


@dataclass(slots=True)
class Token:
    """A piece of text, its lower-case form without outer stops where it is a word, and how many brackets are open before it."""

    text: str
    word: str
    depth: int


def tokens(text: str) -> list[Token]:
    out, open_ = [], []
    for found in _TOKEN.findall(text):
        if found in _CLOSE and open_:
            open_.pop()
        out.append(Token(found, "" if found.isspace() else found.lower(), len(open_)))
        if found in _OPEN:
            open_.append(found)
    return out


def words_at(row: list[Token], at: int, words: tuple[str, ...]) -> int:
    """Where the token behind ``words`` stands, if they begin at ``at``, else -1; a last word may carry stops."""
    for k, word in enumerate(words):
        while k and at < len(row) and not row[at].word:
            at += 1
        if at >= len(row) or (row[at].word if k + 1 < len(words) else row[at].word.rstrip(".!?")) != word:
            return -1
        at += 1
    return at


def any_at(row: list[Token], at: int, phrases: dict[str, list]) -> bool:
    """Whether one of the phrases (of ``_by_first``) begins at ``at``."""
    word = row[at].word
    return any(words_at(row, at, words) > 0 for first in {word, word.rstrip(".!?")} for words, *_ in phrases.get(first, ()))


def plain(row: list[Token]) -> str:
    return " ".join("".join(t.text for t in row).split())


def split_at(row: list[Token], parts: str, and_before_names: bool = False) -> Iterator[list[Token]]:
    """Runs of tokens between outer tokens of ``parts`` and outer words ``and``, the latter perhaps only before names."""
    base, run = min((t.depth for t in row), default=0), []
    for i, t in enumerate(row):
        between = t.depth == base and t.text in parts
        if t.text == "and" and t.depth == base:
            behind = next((x for x in row[i + 1 :] if x.word), None)
            between = not and_before_names or behind is not None and (behind.text == "the" or behind.text[0].isupper())
        if between:
            yield run
            run = []
        else:
            run.append(t)
    yield run


def _without_and(text: str) -> str:
    return text[4:].strip(" .") if text[:4].lower() == "and " else text


def direction(name: str) -> tuple[bool, str]:
    """Whether an area is a part (or the rest) of a place, and the place's name without that and without ``mainland``."""
    words = name.split()
    low = [w.lower().replace("-", "") for w in words]
    at = 1 if low[:1] == ["the"] else 0
    part = 0
    if low[at : at + 2] == ["rest", "of"]:
        part = at + 2
    else:
        sides = (*SIDES, *CORNERS)
        if at + 1 < len(low) and low[at] in BEFORE_SIDES and low[at + 1] in sides:
            at += 1
        if at < len(low) and low[at] in sides:
            at += 1
            if low[at : at + 1] == ["and"]:
                at += 2 if low[at + 1 : at + 2] == ["extreme"] else 1
                at = at + 1 if at < len(low) and low[at] in sides else len(low)
            if low[at : at + 1] in (["portion"], ["portions"]) and low[at + 1 : at + 2] == ["of"]:
                part = at + 2
    rest = words[part:] if 0 < part < len(words) else words
    is_part = rest is not words
    return is_part, " ".join(rest[1:] if len(rest) > 1 and rest[0].lower() == "mainland" else rest)


def _brackets(row: list[Token]) -> tuple[list[Token], list[Token] | None]:
    """An area before its round brackets and what stands in them, if they end it."""
    solid = [i for i, t in enumerate(row) if t.word]
    first = next((i for i in solid if row[i].text == "("), None)
    if first is None or row[solid[-1]].text != ")":
        return row, None
    return row[:first], row[first + 1 : solid[-1]]


def _blocks(row: list[Token]) -> Iterator[tuple[int, list[Token]]]:
    """Each signal's number and the tokens of its places, with commas in place of heads of island groups."""
    signal, block, described = None, [], False
    at = 0
    while at < len(row):
        t = row[at]
        head = at if t.word != "wind" else next((i for i in range(at + 1, len(row)) if row[i].word), at)
        if row[head].word in SIGNAL_WORDS:
            solid = [i for i in range(head + 1, min(head + 6, len(row))) if row[i].word]
            if len(solid) > 1 and row[solid[0]].word in NUMBER_WORDS and len(row[solid[1]].text) == 1 and row[solid[1]].text.isdigit():
                if signal is not None:
                    yield signal, block
                signal, block, described = int(row[solid[1]].text), [], False
                at = solid[1] + 1
                continue
        described = described or any_at(row, at, _DESCRIBED)
        if not described and signal is not None:
            behind = next((x.text for x in row[at + 1 :] if not x.text.isspace() or x.text == "\n"), "\n")
            island = t.word in ISLAND_GROUPS and behind in ("\n", ":") and (at == 0 or row[at - 1].text.isspace())
            block.append(Token(",", ",", 0) if island else t)
        at += 1
    if signal is not None:
        yield signal, block


@udtf(returnType="signal int, pos int, town_pos int, area string, kind string, province string, within string, item string")
class ParseSignals:
    """Rows of a wind signal section: one per area and one per town in an area's brackets (``kind`` city, ``within`` the area).

    Areas end where the winds are described. ``kind`` is portion for a part or the rest of a place, else place;
    ``province`` is the area's name without its direction, ``item`` the area with its brackets. A section that says that
    there is no signal, an empty one and null have no rows.
    """

    def eval(self, text: str):
        if not text or NO_SIGNAL in " ".join(text.lower().split()):
            return
        pos = 0
        for signal, block in _blocks(tokens(text)):
            for run in split_at(block, ",;", and_before_names=True):
                item = _without_and(plain(run).strip(_EDGE))
                if not item:
                    continue
                head, inner = _brackets(run)
                area = _without_and(plain(head).strip(_EDGE)) if inner is not None else item
                part, province = direction(area)
                yield signal, pos, -1, area, "portion" if part else "place", province, None, item
                towns = [_without_and(plain(town).strip(" .")) for town in split_at(inner or [], ",;")]
                for town_pos, town in enumerate(t for t in towns if t):
                    yield signal, pos, town_pos, town, "city", province, area, item
                pos += 1


@udtf(returnType="pos int, part string, towns array<string>")
class SplitAreas:
    """The areas of a list, parted outside brackets by commas, semicolons and ``and`` before a name, with the towns in their brackets."""

    def eval(self, text: str):
        runs = [(run, plain(run).strip(" .")) for run in split_at(tokens(text or ""), ",;", and_before_names=True)]
        for pos, (run, part) in enumerate((run, part) for run, part in runs if part):
            towns = [plain(t) for t in split_at(_brackets(run)[1] or [], ",")]
            yield pos, part, [t for t in towns if t]


@udtf(returnType="sentence int, entry int, status string, likelihood string, areas string, name string, whole boolean, towns array<string>, unmatched string")
class ParseAreas:
    """Areas that an advisory's phrases lead up to, paragraph by paragraph, a row each.

    They end before a time (``within``, ``for the next``), ``which may`` or ``and may``, or with the paragraph, but not at
    a full stop, which names hold. Outer commas and ``and`` part them. ``areas`` is all that the phrase leads up to; an
    area without brackets is ``whole``; one that cannot be read keeps its text as ``unmatched``. ``likelihood`` (MORE or
    LESS) is that of a watch, else empty.
    """

    def eval(self, text: str):
        sentence = 0
        for paragraph in (text or "").split("\n"):
            row = tokens(" ".join(paragraph.split()))
            found, read_to = [], {}
            for at, t in enumerate(row):
                for words, tail, likelihood, status in _LEADS.get(t.word, ()):
                    behind = words_at(row, at, words)
                    if behind < 0 or at < read_to.get(tail, 0):
                        continue
                    end = next((i for i in range(behind + 2, len(row)) if any_at(row, i, _ENDS)), len(row))
                    if plain(row[behind:end]).strip(" ."):
                        read_to[tail] = end
                        found.append((status, likelihood, row[behind:end]))
            for status, likelihood, run in found:
                areas = plain(run)
                areas = areas[:-1].rstrip() if areas.endswith(".") else areas
                if plain(run).endswith("."):
                    last = max(i for i, t in enumerate(run) if t.word)
                    run = [*run[:last], Token(run[last].text[:-1], run[last].word[:-1], run[last].depth)]
                for entry, piece in enumerate(p for p in split_at(run, ",") if plain(p)):
                    yield (sentence, entry, status, likelihood, areas, *self._entry(piece))
                sentence += 1

    @staticmethod
    def _entry(piece: list[Token]) -> tuple[str | None, bool, list[str], str | None]:
        head, inner = _brackets(piece)
        words = [w for w in plain(head).lstrip("# ").split(" ") if w]
        if words[:1] and words[0].lower() == "the" and len(words) > 1:
            words = words[1:]
        if len(words) > 2 and words[0].lower() in ("portion", "portions", "rest") and words[1].lower() == "of":
            words = words[2:]
        name = " ".join(words)
        if not name or any(c in name for c in "()"):
            return None, False, [], plain(piece)
        towns = [plain(t) for t in split_at(inner or [], ",")]
        return name, inner is None, [t for t in towns if t], None


def register(spark: SparkSession) -> SparkSession:
    """``spark`` with ``parse_signals``, ``parse_areas`` and ``split_areas`` as SQL table functions."""
    spark.udtf.register("parse_signals", ParseSignals)
    spark.udtf.register("parse_areas", ParseAreas)
    spark.udtf.register("split_areas", SplitAreas)
    return spark
