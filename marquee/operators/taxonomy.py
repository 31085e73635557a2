"""Two-level genre taxonomy from nested raw lists, and its checks."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import text
from marquee.operators import aggregates


def display_name(html: Column) -> Column:
    """Entities and tags out, white space collapsed."""
    plain = F.regexp_replace(html, "&amp;?", "&")
    plain = F.regexp_replace(plain, "(?i)&eacute;", "e")
    return text.clean(F.regexp_replace(plain, "<[^>]*>", " "))


def _acronym(word: Column) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(K.GENRE_ACRONYMS.items())])
    return F.try_element_at(table, F.lower(word))


def _capitalized(word: Column) -> Column:
    """Lower-case, with the first Latin letter in upper case wherever it stands."""
    low = F.lower(word)
    letter = F.regexp_instr(low, F.lit("[a-z]"))
    upper = F.concat(
        low.substr(F.lit(1), letter - 1), F.upper(low.substr(letter, F.lit(1))), low.substr(letter + 1, F.length(low))
    )
    return F.when(letter > 0, upper).otherwise(low)


def title_case(c: Column) -> Column:
    """Words and parts between hyphens capitalized, acronyms as listed."""
    part = lambda p: F.coalesce(_acronym(p), _capitalized(p))
    word = lambda w: F.coalesce(_acronym(w), F.array_join(F.transform(F.split(w, "-", -1), part), "-"))
    return F.array_join(F.transform(F.split(c, r"\s+", -1), word), " ")


def derived_keywords(name: Column, is_super: Column) -> Column:
    """Keywords of a display name: parentheses dropped, cut at & and /, scraps and, for subgenres,
    words that are too common dropped."""
    bare = text.clean(F.regexp_replace(name, r"\([^)]*\)", " "))
    parts = F.transform(F.split(bare, r"\s*[&/]\s*", -1), text.normalize_text)
    scrap = lambda n: F.forall(F.split(n, " "), lambda t: F.length(t) <= 2)
    common = lambda n: ~is_super & ~F.contains(n, F.lit(" ")) & n.isin(K.GENRE_DENY)
    return F.array_distinct(F.filter(parts, lambda n: (n != "") & ~scrap(n) & ~common(n)))


def _curated(table: dict[str, list[str]], id: Column) -> Column:
    chosen = F
    for key, words in table.items():
        chosen = chosen.when(id == key, F.array(*[F.lit(w) for w in words]))
    listed = F.transform(chosen.otherwise(F.array().cast("array<string>")), text.normalize_text)
    return F.array_distinct(F.filter(listed, lambda w: w != ""))


def _weight(super_id: Column) -> Column:
    chosen = F
    for weight, ids in K.GENRE_WEIGHTS.items():
        chosen = chosen.when(super_id.isin(ids), F.lit(weight))
    return chosen


def _records(named: DataFrame, supers: bool) -> DataFrame:
    keywords = derived_keywords(F.col("name"), F.lit(supers))
    auto = F.when(F.col("id").isin(K.GENRE_NO_AUTO), F.array().cast("array<string>")).otherwise(keywords)
    return named.select(
        "id",
        title_case(F.col("name")).alias("label"),
        "parent",
        F.array_distinct(F.concat(auto, _curated(K.GENRE_KEYWORDS, F.col("id")))).alias("keywords"),
        _weight(F.coalesce("parent", "id")).alias("weight"),
        _curated(K.GENRE_ALIASES, F.col("id")).alias("aliases"),
        "hybrids",
        "name",
    )


ENTRY = r"data-code='([^']+)'>([^<]*)</a>"


def listed_entries(raw: DataFrame) -> DataFrame:
    """(code, super, name, place) for every entry of the nested lists."""
    entries = raw.select(
        F.col("id").alias("super"), F.col("ord").alias("s_ord"), F.posexplode("genrelist").alias("pos", "html")
    )
    return entries.select(
        "super", "s_ord", "pos",
        text.extract(F.col("html"), ENTRY, 1).alias("code"),
        display_name(F.regexp_extract("html", ENTRY, 2)).alias("name"),
    ).where(F.col("code").isNotNull())


def build(raw: DataFrame, supers: list[str] = K.SUPER_GENRES) -> DataFrame:
    """raw: (id, ord, name, genrelist) per super-genre -> taxonomy records with `ord`.

    A subgenre belongs to the super-genre its code starts with; the others that list it are hybrids.
    """
    place = F.struct("s_ord", "pos")
    named = F.when(F.col("name") != "", place)
    subs = (
        listed_entries(raw)
        .groupBy("code")
        .agg(
            F.coalesce(F.min_by("name", named), F.lit("")).alias("name"),
            F.transform(F.array_sort(F.collect_set(F.struct("s_ord", "super"))), lambda x: x["super"]).alias("listed"),
        )
        .withColumn("parent", F.substring("code", 1, 3))
        .where(F.col("parent").isin(supers))
        .withColumn("hybrids", F.filter("listed", lambda s: s != F.col("parent")))
        .withColumnRenamed("code", "id")
    )
    tops = raw.where(F.col("id").isin(supers)).select(
        "id", "ord", display_name(F.col("name")).alias("name"),
        F.lit(None).cast("string").alias("parent"), F.array().cast("array<string>").alias("hybrids"),
    )
    top_order = tops.select("id", F.struct(F.lit(0).alias("level"), F.col("ord").alias("n"), F.col("id").alias("code")).alias("ord"))
    sub_order = F.struct(F.lit(1).alias("level"), F.lit(0).cast("int").alias("n"), F.col("id").alias("code")).alias("ord")
    a = _records(tops, True).join(top_order, "id")
    b = _records(subs, False).withColumn("ord", sub_order)
    return a.withColumn("ord", F.struct(F.col("ord.level"), F.col("ord.n").cast("int").alias("n"), F.col("ord.code"))).unionByName(b)


def has_odd_brackets(name: Column) -> Column:
    """Brackets inside a word, or that start with '&'."""
    return name.rlike(r"\w\(|\)\w") | name.rlike(r"\(\s*&")


def terms_of(genres: DataFrame) -> DataFrame:
    return genres.select("id", F.explode(F.concat("keywords", "aliases")).alias("term"))


def forbidden_terms(genres: DataFrame, forbidden: list[str] = K.GENRE_FORBIDDEN) -> DataFrame:
    return terms_of(genres).where(F.col("term").isin(forbidden))


def shared_terms(genres: DataFrame) -> DataFrame:
    """Terms on more than one record."""
    return (
        terms_of(genres).groupBy("term").agg(F.count_distinct("id").alias("n_records"), F.min("id").alias("first_id"))
        .where(F.col("n_records") > 1)
    )


def records_without_terms(genres: DataFrame) -> DataFrame:
    return genres.where((F.size("keywords") == 0) & (F.size("aliases") == 0))
