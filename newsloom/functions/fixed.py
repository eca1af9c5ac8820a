"""Fixed values.

Everything in this module is a value that decides results: word lists, patterns, message
formats, thresholds. Changing one changes what a digest contains.
"""

# --- Fixed values: messages that carry no news (whole message, punctuation ignored) --------
LOW_VALUE_PHRASES = (
    "selamat pagi", "selamat siang", "selamat sore", "selamat malam",
    "gm", "gn", "gmn", "hai", "halo", "hello", "hi", "ok", "oke", "yes", "no",
    "good morning", "good night", "good evening", "pagi", "siang", "sore", "malam",
    "hehe", "haha", "wkwk", "hmm", "hm", "ya", "iya", "enggak", "nggak",
    "mantap", "sip",
)

# --- Fixed values: platforms, look-back, batching, labelling --------------------------------
DISCORD = "discord"
TELEGRAM = "telegram"
PLATFORMS = (TELEGRAM, DISCORD)
LOOKBACK_HOURS = 24
DAILY_BATCH_SIZE = 10
DEFAULT_BATCH_SIZE = 250
MAX_ATTEMPTS = 3
KEEP = "true"
KEEP_SCORE = "0.70"
FALLBACK_KEEP = "false"
FALLBACK_SCORE = "0.0"
TOPICS = ("news", "governance", "product", "feedback", "scam", "education", "security")

# --- Fixed values: alert texts ----------------------------------------------------------------
ALERT_PREFIX = "🚨 *ERROR NOTIFICATION*\n\n"
ALERT_NO_MESSAGES = "⚠️ No messages collected from any source."
ALERT_NOTHING_TO_LABEL = "❌ No valid messages to classify."
ALERT_SOURCE_ERROR = {DISCORD: "❌ Discord %s error: %s", TELEGRAM: "❌ Telegram %s error: %s"}
ALERT_HTTP_STATUS = {
    401: "❌ Invalid token or missing 'Read Message History' permission.",
    403: "❌ Bot lacks access to this channel.",
    404: "❌ Channel ID not found.",
}
ALERT_HTTP_OTHER = "⚠️ HTTP %s: %s"
ALERT_UNREADABLE = "⚠️ %s: %d of %d rows cannot be read."
ALERT_BODY_CHARS = 200

# --- Fixed values: character classes (spelt so that Java and RE2 read them alike) -------------
# White space and word characters in the Unicode sense; written to go inside brackets.
WS = r"\x09-\x0D\x1C-\x20\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"

# --- Fixed values: links in raw message text ------------------------------------------------
LINK_PATTERN = rf'https?://[^{WS}<>"]+|www\.[^{WS}<>"]+'
LINK_TAIL_CHARS = ")]\"',.!;"
LINK_MIN_LENGTH = 11

# --- Fixed values: web addresses that cleaning removes ------------------------------------------
# Scheme or www, optional user part, IPv4 address or host with a letter-only last label or localhost,
# optional port, optional path that ends at white space or a closing bracket.
URL_SCHEME = r"[hH][tT][tT][pP][sS]?://|[fF][tT][pP]://"
URL_WWW = r"[wW]{3}[0-9]{0,3}\."
URL_USER_CHARS = rf"[^{WS}/@]"
URL_HOST_CHARS = r"[a-zA-Z0-9\x{A1}-\x{FFFF}]"
URL_LAST_LABEL = r"[a-zA-Z\x{A1}-\x{FFFF}]"
URL_IPV4 = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
URL_TAIL = rf"(?::[0-9]{{2,5}})?(?:/[^)\]}}{WS}]*+)?"
# A web address may not start right after one of these.
URL_NOT_AFTER = rf"[{WORD}/.]"

# --- Fixed values: code points with the Unicode property Emoji (ASCII left out) -----------------
EMOJI_RANGES = (
    "A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA "
    "24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 "
    "2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B "
    "267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 "
    "26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F "
    "2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 "
    "2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 "
    "1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F1E6-1F1FF 1F201-1F202 1F21A 1F22F "
    "1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 "
    "1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 "
    "1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 "
    "1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6D7 "
    "1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 "
    "1F947-1F9FF 1FA70-1FA7C 1FA80-1FA89 1FA8F-1FAC6 1FACE-1FADC 1FADF-1FAE9 1FAF0-1FAF8"
)
# Code points that only join or style the emoji before them.
EMOJI_JOINERS = "FE0F 200D E0020-E007F"


def code_point_class(ranges: str) -> str:
    """Hex code points and ranges as the inside of a bracket expression."""
    return "".join(
        "-".join(rf"\x{{{end}}}" for end in item.split("-")) for item in ranges.split()
    )


EMOJI_CHARS = code_point_class(EMOJI_RANGES)
EMOJI_TAIL = code_point_class(EMOJI_JOINERS)
KEYCAP = r"[#*0-9]\x{FE0F}?\x{20E3}"
EMOJI = rf"{KEYCAP}|[{EMOJI_CHARS}][{EMOJI_TAIL}]*"

# --- Fixed values: unicode repair ------------------------------------------------------------------
SINGLE_QUOTES = "ʼ‘’‚‛"
DOUBLE_QUOTES = "“”„‟"
LIGATURES = {
    "Ĳ": "IJ", "ĳ": "ij", "ŉ": "'n", "Ǆ": "DŽ", "ǅ": "Dž", "ǆ": "dž", "Ǉ": "LJ", "ǈ": "Lj",
    "ǉ": "lj", "Ǌ": "NJ", "ǋ": "Nj", "ǌ": "nj", "Ǳ": "DZ", "ǲ": "Dz", "ǳ": "dz",
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ſt", "ﬆ": "st",
}
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&#x27;": "'",
    "&nbsp;": " ", "&amp;": "&",
}
TERMINAL_ESCAPE = r"\x1B\[[0-9;]*[a-zA-Z]"
CONTROL_CHARS = "0-8 B E-1F 7F 206A-206F FEFF FFF9-FFFC"
