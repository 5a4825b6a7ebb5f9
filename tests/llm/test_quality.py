"""Quality metrics and thresholds against plain versions."""

import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tracewarden.llm import quality


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), len(lines),
            len(re.findall("[A-Z]", text)), text.count("!"))


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.text("ab ñ#*\n!\t\x0b\x1c\xa0Q", max_size=80), st.lists(st.sampled_from("ab"), max_size=40).map(" ".join)))
def test_measures(text):
    assert quality.measures(None if text is None else text.encode()) == (slow(text) if slow(text)[0] else (0,) * 8)


@pytest.mark.parametrize("k,n,p", [(0, 5, 0.1), (3, 40, 0.05), (40, 40, 0.2), (7, 900, 0.01)])
def test_binomial_tail(k, n, p):
    q = Fraction(p)
    want = float(sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1)))
    assert quality.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)


def test_cutoffs_stop_at_the_first_failure_and_balance():
    m = len(quality.CUTOFFS)
    lost = [0] * 5 + [1] * 5 + [500] + [0] * (m - 11)
    caught = [0, 3, 3, 9, 9, 30] + [30] * 4 + [900] * (m - 10)
    assert quality.chosen_cutoff(lost, caught, 2000, 0.01, 0.01) == quality.CUTOFFS[5]
    assert quality.chosen_cutoff([0] * m, [0] * m, 2000, 0.01, 0.01) is None
    assert quality.chosen_cutoff([0] * m, [5] * m, 50, 0.01, 0.01) is None  # too few to certify anything


def test_judged(spark):
    good = "the quick brown fox jumps over one lazy dog and two cats sit still here"
    rows = [(i, good + f" {i}", "en", "x") for i in range(900)]
    rows += [(1000 + i, good.replace(" ", "$$ ") + f" {i}", "en", "x") for i in range(60)]
    rows += [(2000, None, "en", "x"), (2001, "", None, "x"), (2002, "few words", "en", "x"), (None, good, None, "x"),
             (2003, good, "en", "x"), (2003, good, "en", "x"), (2004, " ".join(["again and"] * 20), "en", "x"),
             (2005, good.replace(" ", "$$ "), "fr", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality string").repartition(3)
    labels = spark.createDataFrame([(i, 1, None) for i in range(900)] + [(1000 + i, 0, None) for i in range(50)] + [(2003, None, 1), (9999, 1, 1)],
                                   "doc_id long, quality int, text int")
    got = [(r.doc_id, r.quality.base_failed, r.quality.kept, r.quality.rejected_by) for r in quality.judged(docs, labels).collect()]
    assert len(got) == len(rows)
    kept = Counter(d for d, _, k, _ in got if k)
    assert kept == Counter(list(range(900)) + [None, 2003, 2003, 2005])  # fr has no labels: no learned cutoff
    assert all(by == ["symbols"] for d, failed, k, by in got if d and 1000 <= d < 1060)
    assert {d for d, failed, *_ in got if failed} == {2000, 2001, 2002, 2004}
    none = quality.judged(docs, labels.limit(0))
    assert none.filter("quality.kept").count() == 900 + 60 + 5 - 1
    assert quality.keep_good(docs.limit(0), labels).collect() == []
    assert quality.keep_good(docs, labels).columns == docs.columns


def slow_judged(rows, labels):
    """``doc_id, kept`` of rows ``doc_id, text, lang``, by counting for each stratum, rule and cutoff in turn."""
    table = []
    for doc, text, lang in rows:
        m = dict(zip(quality.METRICS, slow(text)))
        failed = m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]
        table.append((doc, lang, failed, {r: m[a] / max(m[b], 1) for r, (a, b) in quality.RULES.items()}))
    known = {}
    for doc, lang, failed, values in table:
        for d, q in labels:
            if d == doc and doc is not None and q is not None and not failed:
                known.setdefault(lang, []).append((q == 1, values))
    limits = {}
    for lang, found in known.items():
        for rule in quality.RULES:
            n, best = sum(good for good, _ in found), None
            for cutoff in quality.CUTOFFS:
                above = [good for good, values in found if values[rule] > cutoff]
                lost, share = sum(above), Fraction(quality.RISK / len(quality.RULES))
                tail = sum(comb(n, i) * share**i * (1 - share) ** (n - i) for i in range(lost + 1))
                if tail > quality.DELTA / (len(known) * len(quality.RULES)):
                    break
                value = len(above) - lost - quality.GOOD_WEIGHT * lost
                if value > 0 and (best is None or value > best[0]):
                    best = value, cutoff
            if best:
                limits[lang, rule] = best[1]
    return [(doc, not failed and not any(values[r] > limits.get((lang, r), 9) for r in quality.RULES)) for doc, lang, failed, values in table]


def test_kept_equals_a_plain_count(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    shout, marks = words.upper(), words.replace(" ", " ## ")
    rows, labels = [], []
    for lang, bad, n in (("", shout, 900), (None, marks, 900), ("de", shout, 60), ("null", marks, 30)):
        for i in range(n):
            rows.append((len(rows), f"{words} {i}", lang))
            labels.append((rows[-1][0], 1))
        for i in range(20):
            rows.append((len(rows), f"{bad} {i}", lang))
            labels.append((rows[-1][0], 0))
        # Not labelled, and bad in another stratum's way.
        rows += [(len(rows) + k, f"{t} 7", lang) for k, t in enumerate((shout, marks))]
    rows += [(rows[0][0], rows[0][1], ""), (None, f"{marks} 1", None)]
    labels += [(5, None), (7, 0), (7, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = quality.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = Counter((r.doc_id, r.quality.kept) for r in found.collect())
    want = slow_judged(rows, labels)
    assert got == Counter(want)
    gone = {(lang, "##" in text) for (_, text, lang), (_, kept) in zip(rows, want) if not kept}
    assert gone == {("", False), (None, True)}
