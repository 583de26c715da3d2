"""Keyword rules: the word lists as data, and the reduction applied before compiling them.

A :class:`KeywordRule` fires when any of its clauses fires.  A :class:`Clause` fires when

* any trigger occurs in the text, and
* any of ``requires`` occurs (when given), and
* none of ``excludes`` occurs.

All tests are substring tests on lower-cased text.  Because of that, a keyword that contains
another keyword of the same OR-list can never change the outcome; :func:`reduce_keywords`
drops it so that fewer terms are evaluated per row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class Clause:
    triggers: tuple[str, ...]
    requires: tuple[str, ...] = ()
    excludes: tuple[str, ...] = ()


@dataclass(frozen=True)
class KeywordRule:
    name: str
    clauses: tuple[Clause, ...]


@dataclass(frozen=True)
class RelevanceRule:
    """Foreign side (keyword or whole word) AND domestic side (keyword)."""

    actors: tuple[str, ...]
    actor_words: tuple[str, ...]
    domestic: tuple[str, ...]


# --------------------------------------------------------------------------------------
# The word lists that define the index.  They must stay exactly as they are
# for the flags to be right.
# --------------------------------------------------------------------------------------

WAR_THREAT_TRIGGERS = (
    "konflik", "perang", "ancaman", "ketegangan", "provokasi", "eskalasi", "sengketa",
    "krisis", "ultimatum", "blokade", "sanksi", "embargo", "intervensi", "agresi",
    "perbatasan",
)
WAR_THREAT_EXCLUDES = ("solusi", "usulkan solusi", "tawarkan solusi")

PEACE_THREAT_TRIGGERS = (
    "gencatan", "perdamaian", "perundingan", "negosiasi", "mediasi", "diplomasi",
    "rekonsiliasi", "kesepakatan damai", "perjanjian", "normalisasi",
)
PEACE_THREAT_REQUIRES = (
    "gagal", "gugur", "macet", "batal", "tegang", "tolak", "mundur", "kandas", "mentah",
    "buntu",
)

MILITARY_BUILDUP_TRIGGERS = (
    "militer", "tentara", "pasukan", "tni", "panglima", "pertahanan", "alutsista",
    "persenjataan", "senjata", "kapal perang", "jet tempur",
)
MILITARY_BUILDUP_REQUIRES = (
    "latihan", "manuver", "mobilisasi", "pengerahan", "siaga", "perkuat",
    "tingkatkan kesiapan", "beli", "akuisisi", "kerahkan", "kirim pasukan", "gelar latihan",
)

WAR_ACT_TRIGGERS = (
    "serangan", "baku tembak", "bentrok", "tembak", "ledakan", "penembakan", "kekerasan",
    "insiden", "penyerangan", "pembantaian", "invasi", "pendudukan", "pemboman", "disekap",
    "disandera", "dianiaya", "aniaya", "diculik", "cegat", "intersepsi",
)
WAR_ACT_CONDITIONAL_TRIGGERS = ("korban",)
WAR_ACT_CONDITIONAL_REQUIRES = (
    "serangan", "bentrok", "tembak", "ledakan", "kekerasan", "penyerangan", "pemboman",
    "konflik",
)

TERROR_ACT_TRIGGERS = (
    "teror", "teroris", "terorisme", "bnpt", "densus", "radikal", "radikalisme",
    "ekstremis", "bom", "peledak", "penangkapan terduga", "jaringan teroris",
    "deradikalisasi",
)

FOREIGN_ACTORS = (
    "amerika", "china", "tiongkok", "rusia", "israel", "palestina", "iran", "korea utara",
    "korea selatan", "malaysia", "filipina", "asean", "pbb", "nato", "pentagon", "gaza",
    "ukraina", "laut china selatan", "taiwan", "hamas", "turkiye", "turki", "zionis",
    "kuwait", "somalia", "kirgistan", "selat hormuz",
)
FOREIGN_ACTOR_WORDS = ("as",)
DOMESTIC_MARKERS = (
    "indonesia", "wni", "tni", "natuna", "kbri", "kedutaan", "menteri luar negeri", "dubes",
)

# End of fixed values.
# --------------------------------------------------------------------------------------

RELEVANCE = RelevanceRule(FOREIGN_ACTORS, FOREIGN_ACTOR_WORDS, DOMESTIC_MARKERS)

RISK_RULES: tuple[KeywordRule, ...] = (
    KeywordRule("war_threat", (Clause(WAR_THREAT_TRIGGERS, excludes=WAR_THREAT_EXCLUDES),)),
    KeywordRule("peace_threat", (Clause(PEACE_THREAT_TRIGGERS, requires=PEACE_THREAT_REQUIRES),)),
    KeywordRule(
        "military_buildup",
        (Clause(MILITARY_BUILDUP_TRIGGERS, requires=MILITARY_BUILDUP_REQUIRES),),
    ),
    KeywordRule(
        "war_act",
        (
            Clause(WAR_ACT_TRIGGERS),
            Clause(WAR_ACT_CONDITIONAL_TRIGGERS, requires=WAR_ACT_CONDITIONAL_REQUIRES),
        ),
    ),
    KeywordRule("terror_act", (Clause(TERROR_ACT_TRIGGERS),)),
)

COMPONENTS: tuple[str, ...] = tuple(rule.name for rule in RISK_RULES)

# Composite indices: which components are summed into each.
COMPOSITES: dict[str, tuple[str, ...]] = {
    "threats_index": ("war_threat", "peace_threat", "military_buildup"),
    "acts_index": ("war_act", "terror_act"),
    "total_index": COMPONENTS,
}


def reduce_keywords(keywords: Iterable[str]) -> tuple[str, ...]:
    """Drop duplicates and every keyword that contains another keyword of the list."""
    unique = tuple(dict.fromkeys(keywords))
    return tuple(k for k in unique if not any(o != k and o in k for o in unique))


def reduce_rule(rule: KeywordRule) -> KeywordRule:
    """Equivalent rule with fewer terms.

    Besides reducing each list, a required word that would already fire an unconditional
    clause of the same rule is dropped: the OR over clauses makes it redundant.
    """
    always = [t for c in rule.clauses if not c.requires and not c.excludes for t in c.triggers]
    clauses = []
    for clause in rule.clauses:
        requires = reduce_keywords(clause.requires)
        if requires:
            requires = tuple(r for r in requires if not any(t in r for t in always))
            if not requires:
                continue  # every way to satisfy this clause already fires another one
        clauses.append(
            Clause(reduce_keywords(clause.triggers), requires, reduce_keywords(clause.excludes))
        )
    return KeywordRule(rule.name, tuple(clauses))
