"""Decoding raw bytes.  Any single-byte charset works without legacy session settings: the bytes
are read one to one as ISO-8859-1 and the differing characters are translated."""

from __future__ import annotations

import codecs
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Charsets that files come in which are not UTF-8; of equally likely ones the first.
EXPORT_CHARSETS = ("windows-1252", "iso-8859-15", "cp850", "cp437", "windows-1250")
BOOKING_CHARSETS = ("windows-1250", "windows-1252", "iso-8859-15", "cp850", "cp437")
EXPORT_FALLBACK = EXPORT_CHARSETS[0]
# The wide charsets by the mark of their byte order.
WIDE_MARKS = {b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}
WIDE = tuple(WIDE_MARKS.values())

# How likely a character is in bookkeeping data, from German letters down to what no text has.
GERMAN_LETTERS, MONEY_AND_QUOTES, ODD = "äöüÄÖÜß", "€§°–„“”’", "¦¬¤‗þÞðÐ"
WEIGHTS = {"german": 12, "money": 6, "western": 5, "central": 3, "sign": 1, "odd": -2, "drawing": -6, "control": -20}


def canonical(charset: str) -> str:
    return codecs.lookup(charset).name


def is_utf8(charset: str) -> bool:
    return canonical(charset) in ("utf-8", "utf-8-sig", "ascii")


def _first(data: bytes, charset: str) -> str | None:
    try:
        return codecs.getincrementaldecoder(charset)().decode(data)
    except UnicodeDecodeError:
        return None


def single_byte_map(charset: str) -> tuple[str, str]:
    """The characters in which a single-byte charset differs from ISO-8859-1."""
    # A decoder that waits for more after a single byte has characters of several.
    waits = any(_first(bytes([code]), charset) == "" for code in range(256))
    if waits or len("a;".encode(charset)) != 2:
        raise ValueError(f"charset must be UTF-8 or a single-byte one, not '{charset}'")
    pairs = []
    for code in range(256):
        try:
            char = bytes([code]).decode(charset)
        except UnicodeDecodeError:
            continue  # unassigned: keep the control character of that code
        if char != chr(code):
            pairs.append((chr(code), char))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _weight(code: int, charset: str) -> int:
    try:
        char = bytes([code]).decode(charset)
    except UnicodeDecodeError:
        return WEIGHTS["control"]
    kind = unicodedata.category(char)
    if char in GERMAN_LETTERS:
        return WEIGHTS["german"]
    if char in MONEY_AND_QUOTES:
        return WEIGHTS["money"]
    if kind == "Cc":
        return WEIGHTS["control"]
    if 0x2500 <= ord(char) < 0x25A0:
        return WEIGHTS["drawing"]
    if char in ODD or kind in ("Sk", "Lm", "Lo") or (kind == "No" and char not in "²³"):
        return WEIGHTS["odd"]
    if kind in ("Lu", "Ll"):
        # Western letters stand in Latin-1; those of Central Europe come after it.  Capitals are rarer.
        return WEIGHTS["western" if ord(char) < 0x100 and kind == "Ll" else "central"]
    return WEIGHTS["sign"]


def byte_weights(charset: str) -> list[int]:
    """A weight for each byte beyond ASCII.  The scores of a text's bytes add up, in any order."""
    return [_weight(code, charset) for code in range(128, 256)]


def likeliest(scores: Column, charsets: tuple[str, ...]) -> Column:
    """The charset of the highest score; of equal ones the first."""
    return F.element_at(
        F.array(*map(F.lit, charsets)), F.array_position(scores, F.array_max(scores)).cast("int")
    )


def wide_order(head: bytes) -> str | None:
    """The wide charset that a file's first bytes tell: by its mark, or by the empty halves of its
    characters."""
    if head[:2] in WIDE_MARKS:
        return WIDE_MARKS[head[:2]]
    head = head[: len(head) // 2 * 2]
    first, second = head[::2].count(0), head[1::2].count(0)
    if max(first, second) * 2 <= len(head) // 2:
        return None
    return "utf-16-be" if first > second else "utf-16-le"


def is_wide(charset: str | None) -> bool:
    return charset is not None and canonical(charset) in WIDE


def wide_text(raw: Column, charset: str) -> Column:
    """A line of a wide charset as text, without the mark and the first half of a line end."""
    text = F.decode(raw, "UTF-16LE" if canonical(charset) == "utf-16-le" else "UTF-16BE")
    return F.regexp_replace(text, "^\ufeff|\r$", "")


def readable(charset: str) -> None:
    """Refuses a charset that lines cannot be read in."""
    if not (is_utf8(charset) or is_wide(charset)):
        single_byte_map(charset)


def chosen_text(raw: Column, charset: Column, charsets: tuple[str, ...]) -> Column:
    """Bytes to text by a column that names one of some charsets, or else UTF-8."""
    text = raw.cast("string")
    for name in charsets:
        text = F.when(charset == name, decoded(raw, name)).otherwise(text)
    return text


def decoded(raw: Column, charset: str) -> Column:
    """Bytes to text.  Lines of a wide charset are text already, see ``lines.text_lines``."""
    if is_utf8(charset) or is_wide(charset):
        return raw.cast("string")
    source, target = single_byte_map(charset)
    text = F.decode(raw, "ISO-8859-1")
    return F.translate(text, source, target) if source else text
