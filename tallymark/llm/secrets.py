"""Secret scans: fixed patterns, and strings near sensitive words that a primed compressor finds new.

A candidate is measured by what it adds to the compressed size of the text around it. All is compressed as the parts of
names, and the compressor starts from a dictionary of words and common identifiers, so names, words and paths that the
dictionary or the surroundings hold cost few bytes a part, while key material costs a byte a character and more.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from pathlib import Path

import public_tokenizers
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Lists, add_columns

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a greedy run, so the same matches as of all runs with the short ones dropped
#: Lower-case stems without which the patterns above, or the sensitive words below, cannot match: cheap to look for.
ASSIGN_STEMS = (b"passw", b"secret", b"token", b"api")
STEMS = (*ASSIGN_STEMS, b"passphrase", b"key", b"credential", b"authoriz", b"bearer", b"signature", b"client", b"session")
IS_HEX = bytes(chr(b) in "0123456789abcdef" for b in range(256))
KINDS = ("assign", "access", "hex", "novel")
SPAN = "array<struct<kind:string,start:int,end:int>>"

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=~-]{12,}")
SENSITIVE = re.compile(
    r"password|passwd|passphrase|secret|token|api[-_ ]?key|access[-_ ]?key|private[-_ ]?key|credential|authorization|bearer|signature"
    r"|client[-_ ]?id|session[-_ ]?id",
    re.IGNORECASE | re.ASCII,
)
#: Names that occur in code everywhere; with them as history a compressor finds them cheaply.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key private_key public_key credential credentials "
    "authorization bearer signature client_id client_secret session session_id username user email account config "
    "configuration settings environment production development localhost example default string number integer boolean "
    "function return import export const static public private class object array length index value values name names "
    "type types path file files filename directory http https www com org net request response header headers content "
    "application json text html utf-8 base64 encode decode encrypt decrypt hash sha256 md5 key keys data database table "
    "select insert update delete where from join order group limit true false null none undefined self this that "
    "the and for with from your you are not have will was can all one has been more when which their there would about "
    "abcdefghijklmnopqrstuvwxyz 0123456789 xxxxxxxxxxxxxxxxxxxxxxxx"
)


PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: Dates, with or without separators, are ordinary whatever their digits.
DATE = re.compile(r"(?<![0-9])(?:19|20)[0-9]{2}[-/._]?[01][0-9][-/._]?[0-3][0-9](?![0-9])")
#: Information of one random character in bits: a digit, a letter of one case, a letter of either case.
DIGIT_BITS, LETTER_BITS, CASED_BITS = 3.3, 4.7, 5.7


def parts(text: str) -> str:
    """The parts of words, names and paths in lower case, each behind a space, without dates.

    Parts end at changes of case, between letters and digits, and at every other character, so a known word is the same
    string in a path, in a constant and in camel case. Key material falls into many short parts instead.
    """
    return "".join(" " + p.lower() for p in PART.findall(DATE.sub(" ", text)))


def known_names(vocabulary: str) -> str:
    """The parts of a tokenizer's vocabulary from four letters on, frequent ones last, and of ``IDENTIFIERS``."""
    ranks = json.loads(Path(vocabulary).read_text())["model"]["vocab"]
    by_rank = sorted(ranks, key=lambda w: (-ranks[w], w))
    own = dict.fromkeys(w.removesuffix("</w>") for w in by_rank)
    return parts(" ".join([*(w for w in own if len(w) >= 4 and w.isascii() and w.isalpha()), IDENTIFIERS]))


DICTIONARY = known_names(public_tokenizers.path("word_bpe_49k.json"))


@dataclass(frozen=True)
class Novelty:
    """A candidate is reported if it adds at least ``per_char`` bytes a character, and ``least`` bits altogether.

    A byte counts as many bits as a random character of the candidate's alphabet carries. ``reach``: characters before or
    behind it in which a sensitive word must stand. ``around``: characters on each side that count as its surroundings.
    ``stretch``: a longer candidate is measured in stretches of so many characters and is reported whole if one of them is
    new, as random characters of a small alphabet become cheap behind many others.
    ``dictionary``: names that count as known, as ``parts`` gives them.
    """

    least: float = 45.0
    per_char: float = 0.85
    reach: int = 64
    around: int = 256
    stretch: int = 64
    dictionary: str = DICTIONARY
    level: int = 12


class Meter:
    """Marginal compressed bytes of a string in its surroundings."""

    def __init__(self, rules: Novelty):
        known = zstandard.ZstdCompressionDict(rules.dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=rules.level)
        self.zstd = zstandard.ZstdCompressor(level=rules.level, dict_data=known, write_content_size=False)
        self.rules = rules

    def size(self, text: str) -> int:
        return len(self.zstd.compress(text.encode("ascii")))

    def marginal(self, before: str, candidate: str, after: str) -> int:
        before, candidate, after = parts(before), parts(candidate), parts(after)
        return self.size(before + candidate + after) - self.size(before + after)

    def is_new(self, text: str, start: int, end: int) -> bool:
        """Whether a stretch of ``text[start:end]`` is incompressible beside what surrounds it."""
        rules = self.rules
        after = text[end : end + rules.around]
        for at in range(start, end, rules.stretch):
            stretch = text[at : min(at + rules.stretch, end)]
            cost = self.marginal(text[max(0, at - rules.around) : at], stretch, after)
            if cost >= rules.per_char * len(stretch) and information(stretch, cost) >= rules.least:
                return True
        return False


def information(candidate: str, cost: int) -> float:
    """Bits in ``cost`` bytes of an ASCII string: each stands for a letter or digit of it, of which there are no more.

    Digits alone are numbers and carry none.
    """
    digits = sum(map(candidate.count, "0123456789"))
    letters = sum(map(str.isalpha, candidate))
    cased = candidate.lower() != candidate != candidate.upper()
    bits = 0 if not letters else digits * DIGIT_BITS + letters * (CASED_BITS if cased else LETTER_BITS)
    return bits * min(1.0, cost / max(1, digits + letters))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points, by start and then in the order of ``KINDS``."""
    raw, found = text.encode("utf-8", "replace"), []
    if _has(raw, ASSIGN_STEMS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if b"\1" * 16 in raw.translate(IS_HEX):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _has(raw: bytes, stems: Iterable[bytes]) -> bool:
    low = raw.lower()
    return any(x in low for x in stems)


def novel_spans(text: str, taken: Iterable[tuple[int, int, int]], rules: Novelty, meter: Meter) -> list[tuple[int, int, int]]:
    """(start, kind, end) of incompressible strings near a sensitive word, without what spans of ``taken`` cover.

    Each run of candidate characters at most ``reach`` before or behind a sensitive word is cut at the spans of
    ``taken`` and at sensitive words, and each part is measured. One pass over the text.
    """
    found: list[tuple[int, int, int]] = []
    if not _has(text.encode("utf-8", "replace"), STEMS):
        return found
    words = [m.span() for m in SENSITIVE.finditer(text)]
    cuts = _union([*((s, e) for s, _, e in taken), *words])
    near = cut = 0
    for m in CANDIDATE.finditer(text) if words else ():
        start, last = m.span()
        while near < len(words) and words[near][1] + rules.reach < start:
            near += 1
        if near == len(words):
            break
        if words[near][0] > last + rules.reach:
            continue
        while cut < len(cuts) and cuts[cut][1] <= start:
            cut += 1
        edges, k = [start], cut
        while k < len(cuts) and cuts[k][0] < last:
            edges += cuts[k]
            k += 1
        edges.append(last)
        for start, end in zip(edges[::2], edges[1::2], strict=True):
            if start < end and meter.is_new(text, start, end):
                found.append((start, 3, end))
    return found


def _union(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Disjoint spans that cover the same places, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def all_spans(text: str, rules: Novelty, meter: Meter) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    return sorted(base + novel_spans(text, base, rules, meter))


def secrets(documents: DataFrame, rules: Novelty = Novelty(), text: str = "text") -> DataFrame:
    """All columns of ``documents`` and ``secrets``: kind, start and end (exclusive, in code points) of each secret.

    Spans are sorted by start, then kind as listed in ``KINDS``; a span of the fixed patterns is never dropped, and
    none of kind ``novel`` overlaps one. A column named ``secrets`` is replaced. A null text counts as empty and has
    no secrets. Whole texts are searched, row by row; nothing is shuffled, and memory holds one batch.
    """

    def start() -> Callable[[Lists], Lists]:
        meter = Meter(rules)

        def scan(cols: Lists) -> Lists:
            out = []
            for raw in cols[text]:
                spans = all_spans(raw.decode("utf-8", "replace") if raw else "", rules, meter)
                out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            return {"secrets": out}

        return scan

    return add_columns(documents, [text], start, f"secrets {SPAN}", per_task=True)


def redact(documents: DataFrame, rules: Novelty = Novelty(), text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``documents`` with each run of overlapping secrets replaced by ``mark``; texts without one stay as they are."""

    def start() -> Callable[[Lists], Lists]:
        meter = Meter(rules)

        def clean(cols: Lists) -> Lists:
            out = []
            for raw in cols[text]:
                body = None if raw is None else raw.decode("utf-8", "replace")
                kept, at = [], 0
                for first, _, end in all_spans(body or "", rules, meter):
                    if first >= at:
                        kept += [body[at:first], mark]
                    at = max(at, end)
                out.append("".join(kept) + body[at:] if kept else body)
            return {text: out}

        return clean

    columns = [f"`{c}`" for c in documents.columns]
    return add_columns(documents, [text], start, f"`{text}` string", per_task=True).select(*columns)


def listing(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
