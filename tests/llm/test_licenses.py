from collections import Counter

import pytest

from basketflow.llm.licenses import TEMPLATES, Scanner, bounds, normalised, scan_licenses


def bigrams(words):
    return set(zip(words, words[1:]))


def brute(text, templates, threshold):
    """Greatest coefficient of any stretch of words for each licence that reaches the threshold."""
    words = normalised(text)
    best = {}
    for name, notice in templates:
        held = bigrams(normalised(notice))
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                own = bigrams(words[i:j])
                score = 2 * len(own & held) / (len(own) + len(held))
                if score >= threshold:
                    best[name] = max(best.get(name, 0), round(score, 6))
    return best


SMALL = [("A", "one two three four five six"), ("B", "licensed under the b licence, version 2"), ("C", "two words")]


@pytest.mark.parametrize(
    "text",
    [
        "",
        "x",
        "zero one two three four five six seven",
        "one two three x four five six",
        "one one two two three three four four five five six six",
        "Licensed\nunder THE b License Version 2! two, words",
        "two words two words one two three four five six",
        "one two three four five",
        "six five four three two one",
    ],
)
@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_best_stretch_is_found(text, threshold):
    found = Scanner(SMALL, threshold).scan(text)
    expected = brute(text, SMALL, threshold)
    assert set(n for n, *_ in found) <= set(expected)
    if expected:
        assert max(s for _, s, _, _ in found) == max(expected.values())
    assert all(a[3] <= b[2] for a, b in zip(found, found[1:]))
    assert all(brute(text[a:b], [t for t in SMALL if t[0] == n], threshold)[n] == s for n, s, a, b in found)


def test_bounds_hold_for_all_sizes():
    for size in range(1, 30):
        low, high, need = bounds(size, 0.8)
        for n in range(1, 60):
            reach = [s for s in range(min(n, size) + 1) if 2 * s >= 0.8 * (n + size) - 1e-9]
            assert bool(reach) == (low <= n <= high)
            assert not reach or reach[0] >= need


def test_every_template_finds_itself():
    scanner = Scanner(TEMPLATES, 0.8)
    for name, text in TEMPLATES:
        assert (name, 1.0) in [m[:2] for m in scanner.scan(f"Noise before it.\n{text}\nand noise behind.")]
    assert scanner.scan("of the people by the people for the people to the end of the world in the software of the day") == []


def test_places_when_lower_case_is_longer():
    found = Scanner(SMALL, 0.8).scan("İİ one two three four five six")
    assert [m[2:] for m in found] == [(3, 30)]


def test_documents_and_odd_rows(spark, docs, odd, none):
    scanner = Scanner(TEMPLATES, 0.8)
    for df in (docs, odd.union(odd.limit(1).selectExpr("12L", "'Released under the MIT License'", *[f"`{c}`" for c in odd.columns[2:]]))):
        expected = Counter((r.doc_id, *m[:2]) for r in df.collect() for m in scanner.scan(r.text or ""))
        rows = scan_licenses(df).collect()
        assert expected and Counter((r.doc_id, r.license, r.dice) for r in rows) == expected
        assert all(r.end_char - r.start_char == len(r.notice) for r in rows)
    assert scan_licenses(none).collect() == []


@pytest.mark.parametrize(
    "notice, name",
    [
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
        ("Licensed under CC BY-NC 3.0.", "CC-BY-NC-3.0"),
        ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("Licensed under CC BY-NC 2.5.", None),
        ("This work is licensed under the GNU General Public License, version 9.", None),
    ],
)
def test_sibling_licenses_are_told_apart(notice, name):
    found = [m[0] for m in Scanner(TEMPLATES, 0.8).scan(f"Some words before it. {notice} Some words behind it.")]
    assert found == ([name] if name else [])


def test_many_templates():
    templates = [(f"T{i}", f"word{i} of the notice number{i} goes here") for i in range(200)]
    scanner = Scanner(templates, 0.8)
    for i in (0, 62, 63, 64, 126, 199):
        assert [m[0] for m in scanner.scan(f"x {templates[i][1]} y")] == [f"T{i}"]


@pytest.mark.parametrize("notice", ["All rights reserved. ", "All rights reserved not. ", "Released under the MIT License. ", next(t for n, t in TEMPLATES if n == "ISC") + " "])
def test_repeated_notices_take_time_in_proportion(notice):
    """Steps, counted rather than timed: four times the text takes about four times as many."""
    import basketflow.llm.licenses as module

    def steps(times):
        count, plain = 0, module._Repeats.next_new

        def counted(self, place, first):
            nonlocal count
            count += 1
            return plain(self, place, first)

        module._Repeats.next_new = counted
        try:
            found = Scanner(TEMPLATES, 0.8).scan(notice * times)
        finally:
            module._Repeats.next_new = plain
        return count, len(found)

    (few, found), (many, more) = steps(200), steps(800)
    assert many <= 5 * few and more >= 3.9 * found > 0


def test_next_new_place():
    import random

    from basketflow.llm.licenses import _Repeats

    rng = random.Random(2)
    words = [rng.choice("abc") for _ in range(700)] + ["z"] + ["a", "b"] * 400 + ["y", "a"]
    seen = _Repeats(words)
    pairs = list(zip(words, words[1:]))
    for _ in range(300):
        first = rng.randrange(len(pairs))
        place = rng.randrange(first, len(pairs))
        expected = next((p for p in range(place, len(pairs)) if pairs[p] not in pairs[first:p]), None)
        assert seen.next_new(place, first) == expected
