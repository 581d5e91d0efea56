from conftest import rows_of
from llm_fixtures import rng, table  # noqa: F401

from dimflow.llm import licences
from dimflow.llm.licences import SENTENCES


def scan(table, *texts):
    return rows_of(licences.scan(table(list(enumerate(texts)))), "doc_id", "licence", "rule", "matches")


def test_notices_among_other_text(spark, table):
    notice = SENTENCES["gpl-3-notice"]
    found = scan(
        table,
        f"Some words.\n{notice}.\nMore words",
        "junk without an end\nReleased under the MIT License.",
        "licensed UNDER  the apache-license, version 2.0!",
        "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.",
        "Nothing of that kind. Not a license? Licensees differ.",
    )
    assert found == [
        (0, "GPL-3.0", "gpl-3-notice", 1), (1, "MIT", "mit-notice", 1), (2, "Apache-2.0", "apache-2-notice", 1),
        (3, "CC-BY-NC-4.0", "cc-by-nc-4-notice", 2), (4, "unknown", "unknown", 1),
    ]


def test_sequences_and_the_order_of_rules(spark, table):
    whole = ". ".join(SENTENCES[i] for i in ("gpl-3-grant", "gnu-hope", "gpl-details", "gpl-received")) + "."
    wrapped = SENTENCES["mit-grant"].replace(" and associated", "\nand associated").replace(" (the", "\n(the")
    mit = f"{wrapped}.\n\n{SENTENCES['as-is']}.\n{SENTENCES['no-liability']}."
    part = f"{SENTENCES['gpl-3-grant']}. A word between. {SENTENCES['gnu-hope']}. {SENTENCES['gpl-details']}."
    found = scan(table, whole, mit, part)
    assert found == [
        (0, "GPL-3.0-or-later", "gpl-3-grant+gnu-hope+gpl-details+gpl-received", 1),
        (1, "MIT", "mit-grant+as-is+no-liability", 1),
        (2, "GPL-3.0-or-later", "gpl-3-grant", 1),
    ]


def test_longer_texts_of_other_licences(spark, table):
    """Sequences that share their first sentences: the longest rule takes them."""
    def text(*ids):
        return "\n".join(f"{SENTENCES[i]}." for i in ids)

    bsd = ("bsd-grant", "bsd-source", "bsd-binary")
    tail = ("bsd-as-is", "bsd-no-liability")
    found = scan(
        table,
        text(*bsd, "bsd-endorse", *tail),
        text(*bsd, *tail),
        text("isc-grant", "isc-as-is", "isc-no-liability"),
        text("lgpl-2.1-grant", "gnu-library-hope", "lgpl-details", "lgpl-received"),
        text("agpl-3-grant", "gnu-hope", "agpl-details"),
        "This Source Code Form is subject\nto the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "version\n2.0\nof something",
        text("cc-by-nc-sa-4-work", "cc-by-4-work", "cc-by-4-work"),
    )
    assert found[5][2] == "mpl-2-notice+mpl-2-version+mpl-2-copy-2"
    assert [(doc, licence, matches) for doc, licence, _, matches in found] == [
        (0, "BSD-3-Clause", 1), (1, "BSD-2-Clause", 1), (2, "ISC", 1), (3, "LGPL-2.1-or-later", 1),
        (4, "AGPL-3.0-or-later", 1), (5, "MPL-2.0", 1), (7, "CC-BY-4.0", 2), (7, "CC-BY-NC-SA-4.0", 1),
    ]


def test_brute_force(spark, table, rng):
    """The same by hand: sentences to ids, and rules taken out of the sequence in their order."""
    known = {licences.plain(s): i for i, s in SENTENCES.items()}
    texts = []
    for _ in range(60):
        parts = [rng.choice([*SENTENCES.values(), "Other words here", "More"]) for _ in range(rng.randrange(8))]
        texts.append(". ".join(parts))
    expected = []
    for doc, text in enumerate(texts):
        ids = [known.get(licences.plain(s), ".") for s in text.split(". ") if licences.plain(s)]
        for licence, rule in licences.RULES:
            n, at = 0, 0
            while at + len(rule) <= len(ids):
                if tuple(ids[at : at + len(rule)]) == rule:
                    ids[at : at + len(rule)] = ["."]
                    n += 1
                at += 1
            if n:
                expected.append((doc, licence, "+".join(rule), n))
    assert scan(table, *texts) == sorted(expected, key=repr)


def test_nulls_empty_long_and_repeated(spark, table):
    long = "word " * 50_000 + ".\nReleased under the MIT License."
    rows = [(1, None), (2, ""), (3, long), (None, "Released under the MIT License"), (4, long), (4, long), (5, "...\n\n")]
    found = rows_of(licences.scan(table(rows)), "doc_id", "licence")
    assert sorted(found, key=str) == [(3, "MIT"), (4, "MIT"), (4, "MIT"), (None, "MIT")]
    assert licences.scan(table([])).count() == 0


def test_native(spark, table):
    plan = licences.scan(table([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
