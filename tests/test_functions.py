import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsrisk.functions import lexicon as L
from newsrisk.functions.dates import iso_date, long_date, relative_date, stringify_dates
from newsrisk.functions.lexicon import Clause, KeywordRule, reduce_keywords, reduce_rule
from newsrisk.functions.match import any_keyword, relevance, risk_flags, whole_word
from newsrisk.functions.text import slug_title, title_case

AS_OF = dt.date(2026, 5, 20)
D = dt.date

# title, relevance, war threat, peace threat, military build-up, war act, terror act
GOLDEN = [
    ("Indonesia dan Malaysia bahas sengketa perbatasan", 1, 1, 0, 0, 0, 0),
    ("Indonesia tawarkan solusi konflik Gaza", 1, 0, 0, 0, 0, 0),
    ("Perundingan Indonesia dan Israel gagal", 1, 0, 1, 0, 0, 0),
    ("Diplomasi Indonesia di ASEAN berjalan baik", 1, 0, 0, 0, 0, 0),
    ("TNI gelar latihan bersama Amerika", 1, 0, 0, 1, 0, 0),
    ("WNI ditangkap tentara Israel", 1, 0, 0, 0, 0, 0),
    ("Serangan di Gaza, WNI selamat", 1, 0, 0, 0, 1, 0),
    ("Korban gempa Turki, KBRI kirim bantuan", 1, 0, 0, 0, 0, 0),
    ("Korban konflik Ukraina dibantu Indonesia", 1, 1, 0, 0, 1, 0),
    ("Terorisme lintas batas dibahas Indonesia dan Filipina", 1, 0, 0, 0, 0, 1),
    ("Menteri luar negeri bertemu delegasi AS", 1, 0, 0, 0, 0, 0),
    ("Kasus biasa di Indonesia", 0, 0, 0, 0, 0, 0),
    ("Harga emas naik 2026", 0, 0, 0, 0, 0, 0),
    (None, 0, 0, 0, 0, 0, 0),
    ("", 0, 0, 0, 0, 0, 0),
    ("KRISIS UKRAINA: KEDUTAAN INDONESIA SIAGA", 1, 1, 0, 0, 0, 0),
    ("Kirana Indonesia raih gelar juara", 1, 0, 0, 0, 0, 0),
    ("Bombastis: film Indonesia di China", 1, 0, 0, 0, 0, 1),
]


def each(rows, values, fn):
    df = rows("i int, t string", list(enumerate(values)))
    return [r.v for r in df.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]


def test_golden_headlines(rows):
    df = rows("i int, title string", [(i, g[0]) for i, g in enumerate(GOLDEN)])
    got = (
        df.withColumn("t", F.lower("title"))
        .select("i", relevance("t").alias("rel"), *[c.alias(n) for n, c in risk_flags("t").items()])
        .orderBy("i")
    )
    assert [tuple(r)[1:] for r in got.collect()] == [g[1:] for g in GOLDEN]


def test_reduced_rules_equal_full_rules(rows):
    """Every headline word combination that matters: keywords, pairs, and near misses."""
    lists = [c for r in L.RISK_RULES for c in r.clauses]
    words = sorted({w for c in lists for w in (*c.triggers, *c.requires, *c.excludes)})
    titles = words + [f"{a} {b}" for a in words for b in words]

    def fires(rule, text):
        return any(
            any(t in text for t in c.triggers)
            and (not c.requires or any(t in text for t in c.requires))
            and not any(t in text for t in c.excludes)
            for c in rule.clauses
        )

    df = rows("t string", [(t,) for t in titles])
    got = df.select("t", *[c.alias(n) for n, c in risk_flags("t").items()]).collect()
    for row in got:
        for rule in L.RISK_RULES:
            assert row[f"is_{rule.name}"] == int(fires(rule, row.t)), (row.t, rule.name)


def test_reduction_drops_only_redundant_terms():
    assert reduce_keywords(["teror", "teroris", "bom", "bom"]) == ("teror", "bom")
    war_act = reduce_rule(next(r for r in L.RISK_RULES if r.name == "war_act"))
    assert war_act.clauses[1].requires == ("konflik",)
    implied = KeywordRule("r", (Clause(("a",)), Clause(("b",), requires=("xa",))))
    assert reduce_rule(implied).clauses == (Clause(("a",)),)


def test_keyword_lists(rows):
    df = rows("t string", [("it's 50% of c:\\temp",)])
    hit = lambda *words: df.select(any_keyword("t", words)).first()[0]
    assert hit() is False
    assert hit("it's") is True
    assert hit("x", "IT'S 5") is True
    assert hit("0% of c:\\t") is True
    assert hit("5_%") is False


@pytest.mark.parametrize(
    "text,hit",
    [("as", True), ("delegasi as.", True), ("asean", False), ("biasa", False), ("a_as", False),
     ("éas", True), ("as9", False), ("(as)", True), ("", False)],
)
def test_whole_word_has_ascii_boundaries(rows, text, hit):
    assert rows("t string", [(text,)]).select(whole_word("t", "as")).first()[0] is hit


def test_relative_dates(rows):
    cases = {
        "9 menit lalu": AS_OF,
        "3 jam lalu": AS_OF,
        "3 hari lalu": AS_OF,  # any "lalu" means today
        "kemarin": D(2026, 5, 19),
        "Kemarin 15:37": D(2026, 5, 19),
        "kemarin lalu": D(2026, 5, 19),
        "18 Mei 2026": D(2026, 5, 18),
        " 15 Mei 2026 10:30": D(2026, 5, 15),
        "1 Januari 2025": D(2025, 1, 1),
        "31 Februari 2026 2026-01-01": None,  # a known month decides
        "3 foo 2026 2026-01-02": D(2026, 1, 2),
        "terbit 2026-05-01 pagi": D(2026, 5, 1),
        "2026-13-45": None,
        "invalid date": None,
        "": None,
        None: None,
    }
    assert each(rows, list(cases), lambda c: relative_date(c, AS_OF)) == list(cases.values())


def test_long_dates(rows):
    cases = {
        "Jumat, 15 Mei 2026 14:30 WIB": D(2026, 5, 15),
        "Senin, 1 Januari 2025 08:00 WIB": D(2025, 1, 1),
        "Rabu, 31 Desember 2025 23:59 WIB": D(2025, 12, 31),
        "  Sabtu 16 mei 2026": D(2026, 5, 16),
        "Jumat, 31 Februari 2026": None,
        "Jumat, 100 Mei 2026": None,
        "Jumat, -5 Mei 2026": None,
        "Jumat, 15 May 2026": None,
        "Invalid date": None,
        "Jumat, 15 Mei": None,
        "": None,
        None: None,
    }
    assert each(rows, list(cases), long_date) == list(cases.values())


def test_iso_dates(rows):
    cases = {
        "2026-05-18T21:30:01Z": D(2026, 5, 18),
        "2026-05-18T23:30:01+07:00": D(2026, 5, 18),  # the written date, no zone shift
        "2026-05-19 20:37 Z": D(2026, 5, 19),
        "2026-05-19": D(2026, 5, 19),
        "2026-5-1": D(2026, 5, 1),
        "18 May 2026": D(2026, 5, 18),
        "May 18, 2026": D(2026, 5, 18),
        "on 2026-05-18.": D(2026, 5, 18),
        "abcd-ef-gh 2026-05-18": None,
        "2026-02-30": None,
        "soon": None,
        "": None,
        None: None,
    }
    assert each(rows, list(cases), iso_date) == list(cases.values())


def test_slug_titles(rows):
    cases = {
        "https://x.example/politik/artikel-politik-1": "Artikel Politik",
        "https://x.example/ekonomi/harga-emas-naik-2026-2136744": "Harga Emas Naik 2026",
        "https://x.example/a/judul-utama.html?page=2": "Judul Utama",
        "https://x.example/a/judul-99/": "Judul",
        "https://x.example/a/g20-dan-3d-2": "G20 Dan 3D",
        None: None,
    }
    assert each(rows, list(cases), slug_title) == list(cases.values())
    for text in ("abc1def GHI", "o'neil di bali", "2nd 3RD"):
        assert each(rows, [text], title_case) == [text.title()]


def test_stringify_converts_every_date_column(rows):
    df = rows(
        "week_start date, seen timestamp, total long, idx double",
        [(D(2026, 5, 4), dt.datetime(2026, 5, 4, 10), 27, 1.5)],
    )
    assert tuple(stringify_dates(df).first()) == ("2026-05-04", "2026-05-04", 27, 1.5)
