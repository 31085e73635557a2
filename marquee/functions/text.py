"""Text expressions: folding, similarity, ids, list splitting, name extraction."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import constants as K

# every character that counts as white space when a cell is trimmed or collapsed
WHITE = r"[\s\u00a0\ufeff\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_EDGES = rf"^{WHITE}+|{WHITE}+$"


def no_match_to_null(c: Column) -> Column:
    """'' (what `regexp_extract` gives for no match) becomes null.

    Written without naming `c` twice: nested `nullif` in branches would compute it again and again.
    """
    return F.get(F.array_remove(F.array(c), F.lit("")), F.lit(0))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    return no_match_to_null(F.regexp_extract(c, pattern, group))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def clean(c: Column) -> Column:
    """Collapse runs of white space to one space and trim; null gives ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), rf"{WHITE}+", " "))


def blank_to_null(c: Column) -> Column:
    return no_match_to_null(strip(c))


@cache
def _fold_table() -> tuple[str, str]:
    """Characters whose canonical decomposition is one ASCII character plus marks."""
    marks = [chr(x) for x in range(0x300, 0x370)]
    source, target = [], []
    for code in range(0x80, 0xFFFE):
        if 0xD800 <= code < 0xE000 or 0x300 <= code < 0x370:
            continue
        base = [x for x in unicodedata.normalize("NFD", chr(code)) if x not in marks]
        if len(base) == 1 and ord(base[0]) < 0x80:
            source.append(chr(code))
            target.append(base[0])
    # characters without a partner are deleted by `translate`
    return "".join(source + marks), "".join(target)


def fold_accents(c: Column) -> Column:
    return F.translate(c, *_fold_table())


def normalize_text(c: Column) -> Column:
    """Fold accents, lower-case, turn every run of non-word characters into one space."""
    return F.trim(F.regexp_replace(F.lower(fold_accents(c)), r"\W+", " "))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often lambdas inside use it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def bigram_tokens(c: Column) -> Column:
    """Character bigrams as a set: the n-th occurrence of 'ab' is the token 'ab' + n."""
    n = F.length(c)
    grams = let(
        c, lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substring(s, i, 2))
    )
    grams = F.when(n >= 2, grams).otherwise(F.array().cast("array<string>"))
    # sorted, equal ones follow each other; only repeats look for their first place
    def numbered(grams: Column) -> Column:
        def token(gram: Column, i: Column) -> Column:
            nth = F.when(F.get(grams, i - 1) == gram, i + 2 - F.array_position(grams, gram).cast("int")).otherwise(F.lit(1))
            return F.concat(gram, nth.cast("string"))

        return F.transform(grams, token)

    return let(F.sort_array(grams), numbered)


def dice_of_tokens(a: Column, b: Column) -> Column:
    """Dice coefficient of two non-empty token sets."""
    return 2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))


def dice(a: Column, b: Column) -> Column:
    """Dice coefficient on bigrams; equal strings give 1, shorter than two characters 0."""
    return (
        F.when(a == b, F.lit(1.0))
        .when((F.length(a) < 2) | (F.length(b) < 2), F.lit(0.0))
        .otherwise(dice_of_tokens(bigram_tokens(a), bigram_tokens(b)))
    )


def levenshtein(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b)


def hashable_title(title: Column) -> Column:
    """Normalized title, or the lower-cased one where no Latin letter or digit is left."""
    return F.coalesce(no_match_to_null(normalize_text(title)), F.lower(strip(title)))


def event_id(source: Column, title: Column, date: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", source, hashable_title(title), date)), 1, 16)


def dedupe_key(title: Column, date: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", hashable_title(title), date)), 1, 12)


def split_on(c: Column, pattern: str) -> Column:
    """Split, trim the parts, drop blank ones; null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), pattern, -1), strip)
    return F.filter(parts, lambda x: x != "")


def split_names(c: Column) -> Column:
    return split_on(c, K.NAME_SPLIT)


def split_list(c: Column, separator: str = ",") -> Column:
    return split_on(c, rf"\Q{separator}\E")


def _upper_first(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 2147483647))


def capitalize_words(c: Column, separator: str = " ") -> Column:
    """Upper-case the first letter of every word and leave the rest as it is."""
    return F.array_join(F.transform(F.split(c, rf"\Q{separator}\E", -1), _upper_first), " ")


def slug_to_title(slug: Column) -> Column:
    return capitalize_words(F.trim(F.regexp_replace(slug, "-+", " ")))


def title_from_slug(slug: Column) -> Column:
    """Title of a `some-name-20-06-26` slug: the date goes, every word is capitalized."""
    return capitalize_words(F.regexp_replace(slug, r"-\d{2}-\d{2}-\d{2}$", ""), "-")


def listed_words(c: Column, words: list[str] = K.LISTED_GENRES) -> Column:
    """The listed words that occur in the text, in list order, joined; null if none."""
    low = F.lower(c)
    found = [F.when(F.contains(low, F.lit(w.lower())), F.lit(w)) for w in words]
    return no_match_to_null(F.array_join(F.array(*found), ", "))


def title_artists(title: Column) -> Column:
    """Artists named in a title: 'X: A + B' gives 'A, B', 'X: Name' gives 'Name'."""
    after = F.when(
        F.contains(title, F.lit(":")), strip(F.regexp_replace(title, r"(?s)^[^:]*:", ""))
    )
    plus = F.contains(title, F.lit(" + "))
    listed = F.array_join(split_list(F.coalesce(after, title), " + "), ", ")
    is_subtitle = F.lower(after).rlike("|".join(rf"\Q{h}\E" for h in K.SUBTITLE_HINTS))
    single = F.when((after != F.lower(after)) & ~is_subtitle, after)
    return no_match_to_null(F.when(plus, listed).otherwise(single))


def plus_artists(title: Column) -> Column:
    return F.when(
        F.contains(title, F.lit(" + ")), F.array_join(split_list(title, " + "), ", ")
    )


def lineup_artists(text: Column) -> Column:
    """One name per decorated line-up line, distinct, joined; null if none."""
    names = F.transform(
        F.split(text, r"\r?\n", -1), lambda line: strip(F.regexp_extract(line, K.LINEUP_LINE, 1))
    )
    return no_match_to_null(F.array_join(F.array_distinct(F.filter(names, lambda x: x != "")), ", "))


def room_from_type(kind: Column) -> Column:
    up = F.upper(kind)
    club, bar = up.rlike(r"\bCLUB\b"), up.rlike(r"\bBAR\b")
    art = up.rlike("EXPO|WORKSHOP|PERFORMANCE|MARKET|SHOWCASE|LISTENING")
    return (
        F.when(club & bar, "club+bar").when(club, "club").when(bar, "bar").when(art, "art")
    )


ROOM_AND_TIME = r"(?i)([\w\s()]+?)\s*//\s*(\d{1,2}u\d{0,2})"


def room_of_header(c: Column) -> Column:
    """'ROOM // 20u30' gives the room."""
    return blank_to_null(F.regexp_extract(c, ROOM_AND_TIME, 1))


def time_of_header(c: Column) -> Column:
    """'ROOM // 20u30' gives '20u30'."""
    return extract(c, ROOM_AND_TIME, 2)


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def join_until(parts: Column, limit: int, separator: str = " ") -> Column:
    """Join the parts that are not empty, stop adding once the text is longer than the limit, then cut to it."""
    taken = F.aggregate(
        F.filter(parts, lambda x: x != ""),
        F.lit(""),
        lambda acc, x: F.when(F.length(acc) > limit, acc)
        .when(acc == "", x)
        .otherwise(F.concat(acc, F.lit(separator), x)),
    )
    return no_match_to_null(F.substring(taken, 1, limit))
