"""Text cleaning and tokens as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: patterns and code point blocks that define the cleaning results
TAG = r"<[^>]+>"
NOT_LETTER = r"[^a-zA-Z]"
LONE_LETTER = r"\s+[a-zA-Z]\s+"
BLANKS = r"\s+"
EMOJI_BLOCKS = (
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
)
# end of fixed values

EMOJI = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in EMOJI_BLOCKS) + "]+"

WORD = r"[\p{L}\p{N}]+"
ACCENTED = "àâäáãåçèéêëìíîïñòóôöõùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, TAG, "")


def letters_only(text: Column) -> Column:
    return F.regexp_replace(text, NOT_LETTER, " ")


def drop_lone_letters(text: Column) -> Column:
    """Non-overlapping matches: in ``a b c`` only every second lone letter goes."""
    return F.regexp_replace(text, LONE_LETTER, " ")


def collapse_blanks(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, " ")


def strip_emoji(text: Column) -> Column:
    return F.regexp_replace(text, EMOJI, "")


def clean_text(text: Column) -> Column:
    """Tags, non-letters, lone letters and runs of blanks, in this order; then tags and emoji again."""
    first = collapse_blanks(drop_lone_letters(letters_only(strip_tags(text))))
    return strip_emoji(strip_tags(first))


def word_tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), 1)


def space_tokens(text: Column) -> Column:
    """Parts between single blanks, empty text gives no token."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def fold_accents(text: Column) -> Column:
    return F.translate(text, ACCENTED, PLAIN)


def simple_tokens(text: Column, shortest: int = 2, longest: int = 15) -> Column:
    """Alphabetic runs without accents, lower case, of 2 to 15 letters."""
    runs = F.regexp_extract_all(fold_accents(F.lower(text)), F.lit(r"([\p{L}]+)"), 1)
    return F.filter(runs, lambda t: F.length(t).between(shortest, longest))


def without(tokens: Column, words: list[str]) -> Column:
    """Drop the listed words; order and repeats of the others stay."""
    return F.filter(tokens, lambda t: ~t.isin(words))


def ngrams(tokens: Column, n: int) -> Column:
    """Array of (start, gram) for every run of ``n`` tokens."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(0), F.size(tokens) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts, lambda i: F.struct(i.alias("start"), F.concat_ws(" ", *[F.get(tokens, i + j) for j in range(n)]).alias("gram"))
    )
