"""Text functions: folding, markup, file names, lists in text, booleans in text."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo.functions.entities import decode_entities

# Letters whose ASCII form has no Unicode decomposition.
SINGLE_LETTERS = {"ø": "o", "đ": "d", "ð": "d", "ł": "l", "ı": "i", "ħ": "h", "ŧ": "t"}
LETTER_PAIRS = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}
# Greek and Cyrillic letters and their Latin spelling.
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
    "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
    "ά": "a", "έ": "e", "ή": "e", "ί": "i", "ό": "o", "ύ": "u", "ώ": "o", "ϊ": "i", "ϋ": "u", "ΐ": "i", "ΰ": "u",
}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m",
    "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia", "є": "ie", "і": "i", "ї": "i", "ґ": "g", "ў": "u", "ђ": "dj", "ј": "j",
    "љ": "lj", "њ": "nj", "ћ": "c", "џ": "dz",
}


def _accented_letters() -> dict[str, str]:
    """Lower-case Latin letters with marks, mapped to their ASCII base letter."""
    table = dict(SINGLE_LETTERS)
    for block in (range(0x00C0, 0x0250), range(0x1E00, 0x1F00)):
        for code in block:
            letter = chr(code)
            base = unicodedata.normalize("NFD", letter)[0]
            if letter.islower() and base.isascii() and base.isalpha() and base != letter:
                table[letter] = base
    return table


_ACCENTS = _accented_letters()
_FROM, _TO = "".join(_ACCENTS), "".join(_ACCENTS.values())


def latin_spelling(lower: Column) -> Column:
    """Greek and Cyrillic lower-case letters in Latin ones; a text without any is passed by."""
    letters = GREEK | CYRILLIC
    spelled = lower
    for letter in (k for k, v in letters.items() if len(v) > 1):
        spelled = F.replace(spelled, F.lit(letter), F.lit(letters[letter]))
    single = {k: v for k, v in letters.items() if len(v) == 1}
    spelled = F.translate(spelled, "".join(single) + "".join(k for k, v in letters.items() if not v), "".join(single.values()))
    return F.when(lower.rlike("[\u0370-\u03ff\u0400-\u04ff]"), spelled).otherwise(lower)


def to_ascii_lower(value: Column) -> Column:
    """Lower case with Latin accents removed, Greek and Cyrillic spelled in Latin letters; other scripts stay."""
    lower = latin_spelling(F.lower(value))
    folded = F.translate(lower, _FROM, _TO)
    for pair, replacement in LETTER_PAIRS.items():
        folded = F.replace(folded, F.lit(pair), F.lit(replacement))
    folded = F.regexp_replace(folded, "[\u0300-\u036f]", "")
    # as many bytes as letters: plain ASCII, nothing to fold
    return F.when(F.octet_length(lower) == F.char_length(lower), lower).otherwise(folded)


def strip_text(value: Column) -> Column:
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def fold_text(value: Column) -> Column:
    """ASCII letters, lower case, stripped, full stops removed (in this order)."""
    return F.replace(strip_text(to_ascii_lower(value)), F.lit("."), F.lit(""))


def tokens(value: Column, min_length: int = 1) -> Column:
    """Distinct letter/digit runs of the folded text, in order of appearance."""
    # white space at the ends is cut off with everything else that is no letter or digit
    words = F.split(F.replace(to_ascii_lower(value), F.lit("."), F.lit("")), r"[^\p{L}\p{N}]+")
    found = F.array_distinct(F.array_remove(words, ""))
    return found if min_length <= 1 else F.filter(found, lambda w: F.length(w) >= min_length)


def strip_markup(value: Column) -> Column:
    """Plain text of a title or page: comments, scripts, styles and MathML
    annotations dropped, tags removed, entities decoded, blanks collapsed."""
    text = F.regexp_replace(value, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?is)<(script|style|annotation)\b[^>]*>.*?</\1\s*>", " ")
    text = F.regexp_replace(text, r"(?s)</?[A-Za-z!][^>]*>", " ")
    return F.trim(F.regexp_replace(decode_entities(text), r"(?U)\s+", " "))


def safe_file_name(name: Column) -> Column:
    return F.regexp_replace(name, r"(?U)[^\w\-.]+", "_")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_stem(path: Column) -> Column:
    """Base name without its last extension; a leading dot starts no extension."""
    return F.regexp_replace(base_name(path), r"(?<=[^.])\.[^.]+$", "")


def file_extension(path: Column) -> Column:
    """Last extension in lower case without the dot, ``""`` when there is none."""
    return F.lower(F.regexp_extract(base_name(path), r"(?<=[^.])\.([^.]+)$", 1))


def split_list(text: Column) -> Column:
    """Values of a text list separated by runs of comma, semicolon, pipe or slashes."""
    parts = F.transform(F.split(text, r"[,;|/\\]+"), strip_text)
    return F.filter(parts, lambda p: p != "")


def parse_bool(value: Column, default: bool = False) -> Column:
    """Boolean words; any other non-empty text is true; null gives the default."""
    word = F.lower(strip_text(value))
    return (
        F.when(value.isNull(), F.lit(default))
        .when(word.isin("true", "1", "yes", "y", "t"), F.lit(True))
        .when(word.isin("false", "0", "no", "n", "f"), F.lit(False))
        .otherwise(value != "")
    )
