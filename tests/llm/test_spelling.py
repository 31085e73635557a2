import random
import zlib
from collections import Counter

from marquee.llm import spelling
from marquee.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.conftest import MEDIUM


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_brute_force(counts, times):
    out = {}
    for w, n in counts.items():
        others = sorted((v for v in counts if near(w, v)), key=lambda v: (-counts[v], v))
        form = others[0] if others and counts[others[0]] >= times * n else None
        out[w] = (form, n, len(others), counts[form] if form else None)
    for w in counts:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w] = (*out[w], root)
    return out


def table_of(df):
    return {r.word: (r.form, r.n, r.n_near, r.form_n, r.root) for r in df.collect()}


def test_as_sql(spark):
    assert difference(QUERIES["op11_permuterm_variants"](spark, MEDIUM), connect(MEDIUM), ORACLES["op11_permuterm_variants"]) is None


def test_neighbours_as_brute_force(spark):
    """Words over few letters, so with runs of equal letters, of many lengths and with equal counts."""
    rng = random.Random(5)
    words = {"".join(rng.choices("abé", k=rng.randint(1, 7))): rng.choice([2, 3, 20, 30, 200, 2000, 20000]) for _ in range(700)}
    counts = spark.createDataFrame(list(words.items()), "word string, n long")
    want = by_brute_force(words, 10)
    got = {r.word: r for r in spelling.neighbours(counts).collect()}
    assert set(got) == set(words)
    for w, r in got.items():
        others = sorted((v for v in words if near(w, v)), key=lambda v: (-words[v], v))
        assert (r.n, r.n_near) == (words[w], len(others))
        assert (r.best.word if r.best else None) == (others[0] if others else None)
    docs = spark.createDataFrame([(i, " ".join([w] * min(n, 300))) for i, (w, n) in enumerate(words.items())], "doc_id long, text string")
    kept = {w: min(n, 300) for w, n in words.items()}
    got = table_of(spelling.variants(docs, shortest=1, least=2, every=1 << 40, times=10))
    assert got == by_brute_force(kept, 10) and any(r[4] != w and r[4] != r[0] for w, r in got.items()), want


def test_roots_follow_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(9)] + [("v", "w3")]
    for rounds_for in (10**9, 10**18):
        got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string"), rounds_for, 10).collect()}
        assert got == {**{f"w{i}": "w9" for i in range(9)}, "v": "w9"}


def test_deletions_and_letters(spark):
    """Runs by hand: capitals beyond Z stay, a cut by hash of "<id>:<run>", cuts of null ids."""
    texts = [(i, "Straße ÉCOLEfrançaise naïveté-abcdefgh ABCDEFGH x2y " * 40) for i in range(60)] + [(None, "abcdefgh abcdefgh"), (5, None), (6, "")]
    want = Counter()
    for i, text in texts:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                word = run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]
                want[word] += len(word) >= 7
            run = ""
    want = {w: n for w, n in want.items() if n >= 2}
    got = table_of(spelling.variants(spark.createDataFrame(texts, "doc_id long, text string")))
    assert got == by_brute_force(want, 10) and "Écolefrançaise" in got


def test_odd_rows(spark, odd_docs, no_docs):
    assert spelling.variants(no_docs).count() == 0
    clashing = odd_docs.selectExpr("*", "'x' as word", "1 as n", "2 as key", "3 as id", "4 as run", "5 as at")
    assert table_of(spelling.variants(clashing)) == table_of(spelling.variants(odd_docs))
    long = spark.createDataFrame([(i, "ab" * 1000 + ("c" if i == 2 else "")) for i in (1, 1, 2, 2, 2)], "doc_id long, text string")
    assert sorted((r.n, r.n_near) for r in spelling.variants(long, every=1 << 40).collect()) == [(2, 1), (3, 1)]


def test_partitions_do_not_matter(spark, documents):
    docs = documents.select("doc_id", "text")
    assert table_of(spelling.variants(docs.repartition(13))) == table_of(spelling.variants(docs.coalesce(1)))
