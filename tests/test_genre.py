"""Golden genre cases, on the taxonomy records they involve."""

import pytest
from pyspark.sql import functions as F

from marquee.operators import enrich, taxonomy
from marquee.operators.normalize import to_event
from marquee.sources.dimensions import venue_dimensions
from marquee.schemas import GENRE, VENUE

RECORDS = [
    ("inl", "Industrial & Gothic", None, ["industrial", "gothic"], 3, []),
    ("inl01", "Krautrock", "inl", ["krautrock"], 3, []),
    ("jam", "Jamaican (Music) / Reggae", None, ["jamaican", "reggae"], 3, []),
    ("jam05", "Dub", "jam", [], 3, ["dub reggae", "dub soundsystem", "steppers"]),
    ("rap", "Rap / Hip-Hop Music", None, ["rap", "hip hop music"], 3, []),
    ("rap09", "Trap & Drill", "rap", ["trap", "drill"], 3, []),
    ("dnb", "Drum 'n' Bass (D'n'b) / Jungle", None, ["drum n bass", "jungle", "dnb", "d b", "drum and bass"], 3, []),
    ("tec", "Techno", None, ["techno", "acid techno", "dub techno"], 3, []),
    ("tec04", "Industrial Techno & Schranz", "tec", ["industrial techno", "schranz"], 3, []),
    ("hou", "House", None, ["house"], 3, []),
    ("hou04", "Deep House", "hou", ["deep house"], 3, []),
    ("jaz", "Jazz", None, ["jazz"], 2, []),
    ("rock", "Rocksteady", "gone", ["rocksteady"], 2, []),
]
CASES = {
    "Warehouse Rave w/ Surgeon": (None, None),
    "Acid Techno All Nighter": ("Techno", None),
    "Dub Reggae Soundsystem": ("Jamaican (Music) / Reggae", "Dub"),
    "Liquid DnB & Jungle": ("Drum 'n' Bass (D'n'b) / Jungle", None),
    "Technology Conference afterparty": (None, None),
    "Schranz / Hardgroove": ("Techno", "Industrial Techno & Schranz"),
    "Trap & Drill": ("Rap / Hip-Hop Music", "Trap & Drill"),
    "Krautrock live set": ("Industrial & Gothic", "Krautrock"),
    "House night": ("House", None),
    "Deep House Party": ("House", "Deep House"),
    "Encore: live band": (None, None),
    "Entrapment screening": (None, None),
    "Rocksteady evening": ("gone", "Rocksteady"),
}


@pytest.fixture(scope="module")
def tables(spark):
    genres = spark.createDataFrame([(i, *r) for i, r in enumerate(RECORDS)], "ord int, " + ddl(GENRE))
    venue = ("v", "V", None, ["v"], None, None, None, 0.0, ["Jazz"], None, None, None, None, False)
    venues = spark.createDataFrame([(0, *venue)], "ord int, " + ddl(VENUE))
    return genres, venue_dimensions(venues)


def ddl(schema):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def tagged(spark, tables, rows):
    genres, dims = tables
    df = spark.createDataFrame(rows, "event_id string, title string, genre_raw string, venue_id string")
    done = enrich.with_genre(to_event(df, **{c: F.col(c) for c in df.columns}), genres, dims)
    return {r.event_id: (r.genre, r.subgenre) for r in done.collect()}


def test_golden_cases(spark, tables):
    rows = [(t, t, None, None) for t in CASES]
    assert tagged(spark, tables, rows) == CASES


def test_own_tag_before_text_before_venue(spark, tables):
    rows = [
        ("tag", "Deep House Party", "jazz", None),
        ("useless tag", "Deep House Party", "party", None),
        ("venue", "Some evening", None, "v"),
        ("nothing", "Some evening", None, None),
    ]
    assert tagged(spark, tables, rows) == {
        "tag": ("Jazz", None), "useless tag": ("House", "Deep House"), "venue": ("Jazz", None), "nothing": (None, None),
    }


NAMES = {
    "ALT-ROCK &amp; INDIE": ("Alt-Rock & Indie", ["alt rock"]),
    "(FREE)TEK(K)NO / HARDTEK": ("(Free)tek(k)no / Hardtek", ["tek no", "hardtek"]),
    "HEARTLAND ROCK &amp; A.O.R. (ADULT ORIENTED ROCK)": ("Heartland Rock & A.O.R. (Adult Oriented Rock)", ["heartland rock"]),
    "REGGAET&Eacute;N <i>&amp;</i> LATIN RAP": ("Reggaeten & Latin Rap", ["reggaeten", "latin rap"]),
    "NWOBHM (NEW WAVE OF BRITISH HEAVY METAL)": ("NWOBHM (New Wave Of British Heavy Metal)", ["nwobhm"]),
    "HI-NRG / EURODISCO": ("Hi-NRG / Eurodisco", ["hi nrg", "eurodisco"]),
    "GO-GO (&amp; BOUNCE BEAT)": ("Go-Go (& Bounce Beat)", []),
}


def test_names_and_keywords(spark):
    df = spark.createDataFrame([(k,) for k in NAMES], "raw string").withColumn("name", taxonomy.display_name(F.col("raw")))
    got = df.select(
        "raw", taxonomy.title_case(F.col("name")), taxonomy.derived_keywords(F.col("name"), F.lit(False))
    ).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == NAMES
    odd = df.where(taxonomy.has_odd_brackets(F.col("name"))).count()
    assert odd == 2


def test_first_words_inside_the_row_or_by_the_join(spark, monkeypatch):
    terms = spark.createDataFrame([("deep house", "deep", 2, "g1", 1, 0), ("dub", "dub", 1, "g2", 1, 1)], "term string, first_word string, n_words int, genre_id string, weight int, ord int")
    texts = spark.createDataFrame([("a", 1, "a deep house night"), ("b", 1, "deep dubs"), ("c", 0, "dub"), ("c", 1, "deep house"), ("d", 1, "")], "id string, pass int, text string")
    found = lambda: sorted(tuple(r) for r in enrich.best_genre(texts, "id", terms).collect())
    assert found() == [("a", "g1"), ("c", "g2")]
    monkeypatch.setattr(enrich, "FIRST_WORDS", 1)
    assert enrich.first_words(terms) is None and found() == [("a", "g1"), ("c", "g2")]
