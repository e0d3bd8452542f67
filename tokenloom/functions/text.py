"""Column expressions for tokenising, marking and rendering text (all JVM-side, codegen-able).

P1 tokenize_words, P2 tokenize_delim, P3 tokenize_chars, P4 add_marks, P5 space_chars,
P6 bpe_pretokenize, P7 byte_chars / byte_chars_inverse, helpers for rendering arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour).
#
# Whitespace for split()/strip() without arguments: Java's Unicode \s plus the four
# information separators U+001C..U+001F, which Python also treats as whitespace.
PY_WS_CLASS = r"[\s\x1c-\x1f]"
# Pre-tokeniser of the byte-pair encoder (contractions, optional space + letters / digits /
# other, whitespace runs not followed by a non-space, whitespace runs).
BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Byte -> printable character rule: bytes in these inclusive ranges stand for themselves
# ('!'..'~', U+00A1..U+00AC, U+00AE..U+00FF); every other byte, in ascending order, takes the
# next code point from 256 upwards.
BYTE_SELF_RANGES = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))
EOS = "<eos>"
SENT = "<S>"
# ---------------------------------------------------------------------------------------------

_WS_RUN = "(?U)" + PY_WS_CLASS + "+"
_WS_STRIP = "(?U)^" + PY_WS_CLASS + "+|" + PY_WS_CLASS + "+$"


def py_strip(c: Column) -> Column:
    """``str.strip()`` with Python's whitespace set (Spark ``trim`` drops spaces only)."""
    return F.regexp_replace(c, _WS_STRIP, "")


def chars(c: Column) -> Column:
    """Every code point of a string as one element (empty string -> empty array)."""
    return F.regexp_extract_all(c, F.lit("(?s)."), 0)


def _java_quote(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def tokenize(line: Column, lower: bool = False, delimiter: str | None = None,
             eos: bool = False, double_eos: bool = False) -> Column:
    """Strip, optionally lower-case, split, then add end marks."""
    s = py_strip(line)
    if lower:
        s = F.lower(s)
    if delimiter is None:
        sym = F.filter(F.split(s, _WS_RUN), lambda x: x != F.lit(""))
    elif delimiter == "":
        if eos or double_eos:
            # the reference concatenates str + list here and fails; reject up front
            raise ValueError("character tokenisation takes no end marks")
        sym = chars(s)
    else:
        sym = F.split(s, _java_quote(delimiter), -1)
    return add_marks(sym, eos, double_eos)


def add_marks(symbols: Column, eos: bool = False, double_eos: bool = False) -> Column:
    """``<S> ... <S>`` wins over ``... <eos>`` wins over none."""
    if double_eos:
        return F.concat(F.array(F.lit(SENT)), symbols, F.array(F.lit(SENT)))
    if eos:
        return F.concat(symbols, F.array(F.lit(EOS)))
    return symbols


def space_chars(text: Column) -> Column:
    """P5: every character separated by one space, a space shown as ``_``."""
    return F.array_join(F.transform(chars(text), lambda c: F.when(c == " ", F.lit("_")).otherwise(c)), " ")


def bpe_pretokenize(line: Column) -> Column:
    """Pre-tokens of one line (regex find-all), native."""
    return F.regexp_extract_all(line, F.lit("(?U)" + BPE_PATTERN), 0)


def _other_runs() -> list[tuple[int, int, int]]:
    """Runs of bytes between the self ranges: (first byte, first offset from 256, length)."""
    edges = [0, *(e for lo, hi in BYTE_SELF_RANGES for e in (lo, hi + 1)), 256]
    gaps = [(a, z - a) for a, z in zip(edges[::2], edges[1::2], strict=True) if z > a]
    return [(a, sum(n for b, n in gaps if b < a), n) for a, n in gaps]


def byte_char_table() -> list[tuple[int, str]]:
    """(byte, printable character) for all 256 bytes, from the runs."""
    return sorted([(b, chr(b)) for lo, hi in BYTE_SELF_RANGES for b in range(lo, hi + 1)]
                  + [(a + i, chr(256 + first + i)) for a, first, n in _other_runs() for i in range(n)])


def _byte_to_code(b: Column) -> Column:
    e = None
    for lo, hi in BYTE_SELF_RANGES:
        cond = (b >= lo) & (b <= hi)
        e = F.when(cond, b) if e is None else e.when(cond, b)
    for start, n0, ln in _other_runs():
        e = e.when((b >= start) & (b < start + ln), b - F.lit(start) + F.lit(256 + n0))
    return e


def _code_to_byte(c: Column) -> Column:
    e = F.when(c < 256, c)
    for start, n0, ln in _other_runs():
        e = e.when((c >= 256 + n0) & (c < 256 + n0 + ln), c - F.lit(256 + n0) + F.lit(start))
    return e


def _utf8_hex(c: Column) -> Column:
    """UTF-8 bytes (hex) of a code point below 0x800 (all byte characters are)."""
    return F.when(c < 128, F.lpad(F.hex(c), 2, "0")).otherwise(
        F.concat(F.hex(F.shiftright(c, 6) + 192), F.hex(c.bitwiseAND(F.lit(63)) + 128)))


def byte_chars(token: Column) -> Column:
    """UTF-8 bytes of a token rendered as printable characters (bijective on bytes),
    by arithmetic on byte values (no per-byte map lookups). A token of ASCII characters only, whose bytes are its
    characters, is translated in one step."""
    ascii_ = [(chr(b), ch) for b, ch in byte_char_table() if b < 128 and chr(b) != ch]
    plain = F.translate(token, "".join(a for a, _ in ascii_), "".join(ch for _, ch in ascii_))
    pairs = F.regexp_extract_all(F.hex(F.encode(token, "UTF-8")), F.lit(".."), 0)
    hexs = F.transform(pairs, lambda h: _utf8_hex(_byte_to_code(F.conv(h, 16, 10).cast("int"))))
    return F.when(token.rlike(r"[^\x00-\x7F]"), F.decode(F.unhex(F.array_join(hexs, "")), "UTF-8")).otherwise(plain)


def byte_chars_hex(text: Column) -> Column:
    """Inverse of P7 up to the bytes: printable characters -> hex of the original bytes."""
    bs = F.transform(chars(text), lambda ch: F.lpad(F.hex(_code_to_byte(F.ascii(ch))), 2, "0"))
    return F.array_join(bs, "")


def byte_chars_inverse(text: Column) -> Column:
    """Inverse of P7: printable characters back to text; malformed UTF-8 is replaced."""
    return F.make_valid_utf8(F.unhex(byte_chars_hex(text)).cast("string"))


def ids_str(arr: Column) -> Column:
    """Render an integer array as a space-joined string (for oracle comparison)."""
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), " ")
