"""Text expressions: cleaning, word normalisation, low-value test.

Every function takes and returns a Column, stays in the JVM and can be used in any select or
filter. The regular expressions have no nested repeats over the same characters, so their cost is
linear in the text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from . import fixed as v

# A run of white space that is not already one plain space, so that ordinary text needs no
# replacement at every word.
_WS_RUN = rf"[{v.WS}&&[^ ]][{v.WS}]*+| [{v.WS}]++"
_NOT_WORD = rf"[^{v.WORD}]"
_PUNCT = rf"[^{v.WORD}{v.WS}]"

# Gates: a cheap test of the current character before the long alternation behind it.
_URL_START = rf"(?<!{v.URL_NOT_AFTER})"


def _url(with_user: bool) -> str:
    """Web addresses, so that every character is read a bounded number of times whatever the text.

    - A host is matched without going back: from one label that can be the last to the next.
    - The user part is looked for once in a run of its characters: at the start of the run, if it ends
      with ``@``, for the first www in it. What stands before is put back (group 1). After a scheme a
      run starts anyway.
    - A start without a host takes what it read of one along and puts it back (group 2), up to a place
      where another address may start that is no part of such a host.
    """
    label = rf"{v.URL_HOST_CHARS}++(?:-{v.URL_HOST_CHARS}++)*+"
    last = rf"{v.URL_LAST_LABEL}{{2}}"
    hop = rf"{label}\.(?:(?!{last}){label}\.)*+(?={last})"
    host = rf"(?:{v.URL_IPV4}|(?:{hop})++{v.URL_LAST_LABEL}++|[lL][oO][cC][aA][lL][hH][oO][sS][tT])"
    user = rf"{v.URL_USER_CHARS}++@"
    www = _URL_START + v.URL_WWW
    start = rf"(?:{v.URL_SCHEME}|{v.URL_WWW})"
    other = rf"{_URL_START}(?:{v.URL_SCHEME}|{v.URL_WWW}{v.URL_IPV4})"
    here = rf"(?!{other}){v.URL_HOST_CHARS}"
    read = rf"(?:{here}(?:{here}|[-.](?={v.URL_HOST_CHARS}))*+)?+"
    gate = rf"(?=[hHfFwW]){_URL_START}"
    if not with_user:
        return rf"{gate}(?:{start}{host}{v.URL_TAIL}|({start}{read}))"
    return (
        rf"(?<!{v.URL_USER_CHARS})(?={v.URL_USER_CHARS}*+@)"
        rf"((?:(?!{www}){v.URL_USER_CHARS})*+){www}{user}{host}{v.URL_TAIL}"
        rf"|{gate}(?:{start}(?:(?<=/){user})?{host}{v.URL_TAIL}|({start}{read}))"
    )
_EMOJI = (
    rf"(?=[\x{{A9}}\x{{AE}}\x{{203C}}-\x{{3299}}\x{{1F004}}-\x{{1FAFF}}])"
    rf"[{v.EMOJI_CHARS}][{v.EMOJI_TAIL}]*+|{v.KEYCAP}"
)


def _code_points(ranges: str):
    for item in ranges.split():
        first, _, last = item.partition("-")
        yield from range(int(first, 16), int(last or first, 16) + 1)


def _cp1252() -> dict[str, str]:
    """C1 control -> the printable character windows-1252 has at that byte."""
    table = {}
    for byte in range(0x80, 0xA0):
        try:
            table[chr(byte)] = bytes([byte]).decode("windows-1252")
        except UnicodeDecodeError:
            continue
    return table


def _repair_table() -> tuple[str, str]:
    """One-to-one character repairs as the two strings of ``translate``; a character of the first
    string that has no partner in the second is deleted."""
    table = dict(_cp1252())
    table["\u3000"] = " "
    for point in range(0xFF01, 0xFFF0):  # full-width and half-width forms
        plain = unicodedata.normalize("NFKC", chr(point))
        if plain != chr(point) and len(plain) == 1:
            table[chr(point)] = plain
    for quotes, plain in ((v.SINGLE_QUOTES, "'"), (v.DOUBLE_QUOTES, '"')):
        table.update(dict.fromkeys(quotes, plain))
    for source, target in list(table.items()):  # 0x91 -> curly quote -> straight quote
        table[source] = table.get(target, target)
    deleted = [chr(p) for p in _code_points(v.CONTROL_CHARS)]
    return "".join(table) + "".join(deleted), "".join(table.values())


_REPAIR_FROM, _REPAIR_TO = _repair_table()
_CP1252 = _cp1252()
_BYTES_FROM, _BYTES_TO = "".join(_CP1252.values()), "".join(_CP1252)
_CP1252_LATIN = "".join(c for c in _CP1252.values() if ord(c) < 0x300)
# A UTF-8 lead byte and a following byte, each read as one windows-1252 character.
_BYTE_PAIR = rf"[\x{{C2}}-\x{{F4}}][\x{{80}}-\x{{BF}}{_BYTES_FROM}]"


def _read_as(first: int, last: int) -> str:
    """The inside of a class: a byte in this range, as itself or as the windows-1252 character."""
    printable = "".join(c for c, control in zip(_BYTES_FROM, _BYTES_TO) if first <= ord(control) <= last)
    return rf"\x{{{first:X}}}-\x{{{last:X}}}{printable}"


_FOLLOWS = _read_as(0x80, 0xBF)
_CODED_2 = rf"[\x{{C2}}-\x{{DF}}][{_FOLLOWS}]"
_CODED_3_4 = (
    rf"\x{{E0}}[{_read_as(0xA0, 0xBF)}][{_FOLLOWS}]|[\x{{E1}}-\x{{EC}}\x{{EE}}\x{{EF}}][{_FOLLOWS}]{{2}}"
    rf"|\x{{ED}}[{_read_as(0x80, 0x9F)}][{_FOLLOWS}]|\x{{F0}}[{_read_as(0x90, 0xBF)}][{_FOLLOWS}]{{2}}"
    rf"|[\x{{F1}}-\x{{F3}}][{_FOLLOWS}]{{3}}|\x{{F4}}[{_read_as(0x80, 0x8F)}][{_FOLLOWS}]{{2}}"
)
# A run of characters that spells valid UTF-8. One pair of characters alone is read so only after the two
# lead bytes that no language has before such signs; a capital A with tilde or circumflex that ends
# a word in capitals before a closing quote is not.
_CODED_RUN = (
    rf"(?:{_CODED_2}|{_CODED_3_4})(?:{_CODED_2}|{_CODED_3_4})++|{_CODED_3_4}"
    rf"|(?<!\p{{Lu}})[\x{{C2}}\x{{C3}}][{_FOLLOWS}]"
    rf"|[\x{{C2}}\x{{C3}}](?![\x{{BB}}\x{{201D}}\x{{2019}}\x{{203A}}])[{_FOLLOWS}]"
)
_CODED_PIECES = rf"(?s)(?:{_CODED_RUN})|(?:(?!{_CODED_RUN}).)++"

# Scripts in which no repair, emoji or composition can apply. A text with anything else, an HTML
# entity or what looks like doubly encoded letters takes the full path.
_SETTLED = (
    r"\x09\x0A\x0C\x0D\x{A0}-\x{A8}\x{AA}-\x{AD}\x{AF}-\x{131}\x{134}-\x{148}"
    r"\x{14A}-\x{1C3}\x{1CD}-\x{1F0}\x{1F4}-\x{2BB}\x{2BD}-\x{2FF}"
    r"\x{400}-\x{482}\x{48A}-\x{52F}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}"
)
# Runs of ASCII are tested by their one range, not by a class of many.
_ONLY_SETTLED = rf"\A(?:[\x20-\x7E]+|[{_SETTLED}]+)*+\z"
_DOUBLE_CODED = rf"[\x{{C2}}-\x{{F4}}][\x{{A0}}-\x{{BF}}{_CP1252_LATIN}]"
_LIGATURE = rf"(?=[\x{{132}}-\x{{1F3}}\x{{FB00}}-\x{{FB06}}])[{''.join(v.LIGATURES)}]"
_ENTITY = "&[#0-9A-Za-z]{1,24};"


def _is_settled(text: Column) -> Column:
    """No repair and no emoji in this text. Three short scans cost far less than the repair."""
    return (
        text.rlike(_ONLY_SETTLED) & ~text.rlike(_ENTITY) & ~text.rlike(_DOUBLE_CODED)
    )


def collapse_whitespace(text: Column) -> Column:
    """Line breaks and white space runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, _WS_RUN, " "))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip_urls(text: Column) -> Column:
    """Remove web addresses; text around them stays, also the bracket or comma that follows.

    Only texts with an ``@`` are searched for user parts. The text is named more than once: give a
    column, or use ``_once``.
    """
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, _url(True), "$1$2")) \
        .otherwise(F.regexp_replace(text, _url(False), "$1"))


def strip_emoji(text: Column) -> Column:
    """Remove emoji with their joiners, variation selectors, skin tones, flags and key caps."""
    return F.regexp_replace(text, _EMOJI, "")


def _compose(text: Column) -> Column:
    return F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False)
    )


def compose_nfc(text: Column) -> Column:
    """Canonical composition (NFC) through the ICU library that Spark ships.

    Texts without a character that composition could touch do not reach the call.
    """
    return F.when(~text.rlike(_ONLY_SETTLED), _compose(text)).otherwise(text)


def _as_utf8(text: Column) -> Column:
    """Text whose characters are bytes read as windows-1252, read as UTF-8."""
    return F.encode(F.translate(text, _BYTES_FROM, _BYTES_TO), "ISO-8859-1").cast("string")


def redecode(text: Column) -> Column:
    """Undo UTF-8 read as windows-1252: of the whole text if that explains all of it, else of each run
    of characters that spells valid UTF-8, so text that mixes both encodings is repaired too."""
    def pieces(value: Column) -> Column:
        found = F.regexp_extract_all(value, F.lit(_CODED_PIECES), F.lit(0))
        return F.array_join(F.transform(found, lambda piece: F.when(
            piece.rlike(rf"\A(?:{_CODED_RUN})\z"), _as_utf8(piece)).otherwise(piece)), "")

    def whole(value: Column) -> Column:
        narrow = ~F.translate(value, _BYTES_FROM, _BYTES_TO).rlike(r"[^\x00-\x{FF}]")
        return F.when(narrow, F.when(F.is_valid_utf8(_as_utf8(value)), _as_utf8(value)).otherwise(pieces(value))) \
            .otherwise(pieces(value))

    return F.when(text.rlike(_BYTE_PAIR), whole(text)).otherwise(text)


def _entities(text: Column) -> Column:
    plain = text
    for entity, char in v.ENTITIES.items():
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.when(F.contains(text, F.lit("&")) & ~F.contains(text, F.lit("<")), plain).otherwise(text)


def _ligatures(text: Column) -> Column:
    split = text
    for joined, parts in v.LIGATURES.items():
        split = F.replace(split, F.lit(joined), F.lit(parts))
    return F.when(text.rlike(_LIGATURE), split).otherwise(text)


def _escapes(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\x1b")), F.regexp_replace(text, v.TERMINAL_ESCAPE, "")).otherwise(text)


def repair_unicode(text: Column) -> Column:
    """Double encoding, HTML entities, terminal escapes, ligatures, full-width forms, curly quotes
    and control characters, then NFC. Each step looks by itself whether it is needed.

    Entities are the common ones, and only in text without ``<``.
    """
    out = text
    for step in (redecode, _entities, _escapes, _ligatures):
        out = _once(out, step)
    return _once(F.translate(out, _REPAIR_FROM, _REPAIR_TO), compose_nfc)


def clean_text(text: Column) -> Column:
    """The cleaning applied to every kept message: unicode repair, web addresses and emoji
    removed, white space collapsed. Case, digits, e-mail addresses and punctuation stay; null
    stays null.

    Most texts are told to be settled beforehand and skip the repair and emoji steps. Each step is
    computed once. Spark counts the composition call as non-deterministic: put the result in a column
    before aggregating it, and filter on other columns first, since filters do not move below it.
    """
    other = strip_emoji(_once(repair_unicode(text), strip_urls))
    return collapse_whitespace(F.when(_is_settled(text), strip_urls(text)).otherwise(other))


def normalize_words(text: Column) -> Column:
    """Lower case, punctuation dropped, words joined by one space."""
    return collapse_whitespace(F.regexp_replace(F.lower(text), _PUNCT, ""))


def _letter(char: str) -> str:
    # Capitals whose lower case is this letter, beyond ASCII: Kelvin sign and dotted capital I.
    extra = {"k": r"\x{212A}", "i": r"\x{130}"}
    return f"[{char}{char.upper()}{extra.get(char, '')}]"


def _phrase(phrase: str) -> str:
    words = (f"{_PUNCT}*+".join(_letter(c) for c in word) for word in phrase.split())
    return rf"{_PUNCT}*+[{v.WS}]{_NOT_WORD}*+".join(words)


# Anchored at the start: ordinary text fails within its first letters, so the test does not read
# the rest. Equal to normalize_words(text) being "" or one of the phrases.
_LOW_VALUE = (
    rf"\A{_NOT_WORD}*+(?:(?:{'|'.join(_phrase(p) for p in v.LOW_VALUE_PHRASES)}){_NOT_WORD}*+)?\z"
)


def is_low_value(text: Column) -> Column:
    """True for null, blank or wordless text and for a message that is only a greeting phrase."""
    return F.coalesce(text.rlike(_LOW_VALUE), F.lit(True))
