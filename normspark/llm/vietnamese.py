"""What the text operators know of written Vietnamese: its letters, and which letter strings are syllables."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column

#: All lower-case letters with marks, from the base letters and the five tone marks.
TONES = "\u0300\u0301\u0303\u0309\u0323"
BASES = "aăâeêioôơuưy"
LOWER = "".join(unicodedata.normalize("NFC", b + t) for b in BASES for t in ("", *TONES))
MARKED = "".join(c for c in LOWER if not c.isascii()) + "đ"
LETTERS = MARKED + MARKED.upper()


def ranges(chars: str) -> str:
    """The same characters for a class of a pattern, runs of code points as ranges: Java tries the parts of a class in turn."""
    out: list[list[str]] = []
    for c in sorted(set(chars)):
        if out and ord(out[-1][1]) + 1 == ord(c):
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(a if a == b else f"{a}-{b}" for a, b in out)


#: LETTERS for the patterns of the JVM.
LETTER_CLASS = ranges(LETTERS)


def beyond(text: Column, plain: str) -> Column:
    """Whether ``text`` has a character that is neither in the class ``plain`` nor a Vietnamese letter.

    The text is read once from its start without a way back, which takes a tenth of what a search for the character takes.
    """
    return text.rlike(rf"\A[{plain}{LETTER_CLASS}]*+(?s:.)")

# The initials, the vowel groups and the finals of a written syllable.
ONSET = "b|ch|c|d|đ|gh|gi|g|h|kh|k|l|m|ngh|ng|nh|n|ph|p|qu|r|s|th|tr|t|v|x"
NUCLEUS = (
    "iêu|yêu|oai|oay|oao|oeo|uôi|ươi|ươu|uây|uya|uyê|uyu|uêu|ai|ao|au|ay|âu|ây|eo|êu|iu|oi|ôi|ơi|ui|ưi|ưu|ia|iê|yê|ya|ua|uô|ưa|ươ|"
    "oa|oă|oe|oo|uâ|uê|uy|uơ|a|ă|â|e|ê|i|o|ô|ơ|u|ư|y"
)
CODA = "ch|c|m|ng|nh|n|p|t"
_SYLLABLE = re.compile(f"(?:{ONSET})?(?:{NUCLEUS})(?:{CODA})?")
_NEVER = re.compile("(?:(?<![iy])ê|i|y)(?:ng|c)$|[ăâeoôơuư](?:nh|ch)$")
_STOPPED = re.compile("(?:c|ch|p|t)$")
_TONE = re.compile(f"[{TONES}]")


@lru_cache(maxsize=200_000)
def is_syllable(word: str) -> bool:
    """Whether the letters of ``word`` spell a Vietnamese syllable, by the rules of writing."""
    d = unicodedata.normalize("NFD", word.lower())
    tones = _TONE.findall(d)
    w = unicodedata.normalize("NFC", _TONE.sub("", d))
    if len(tones) > 1 or _SYLLABLE.fullmatch(w) is None or _NEVER.search(w):
        return False
    return not _STOPPED.search(w) or bool(tones and tones[0] in "\u0301\u0323")
