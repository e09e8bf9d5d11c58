"""Queries over whole texts against brute force."""

import random
import struct
from collections import defaultdict

import pytest
import xxhash

import __spark_entry__ as entry
from quire.functions import text
from quire.operators.prepare import UNREADABLE
from quire.plans.corpus import STRETCH
from quire.schema import MARKER, THRESHOLDS


def slow_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.fixture(scope="module")
def long_texts(spark, tmp_path_factory):
    """A folder whose documents go on past a damaged stretch, in letters beyond ASCII; their pages' (reference, baseline) by page_id."""
    draw, folder, texts = random.Random(9), str(tmp_path_factory.mktemp("whole")), {}
    for i in (4, 5, 6, 7, 8, 9, 11, 12, 17, 31):
        lines = [" ".join("".join(draw.choice("aeibdé\u0627\u0628ü") for _ in range(5)) for _ in range(10)) for _ in range(15)]
        texts[i] = "\n".join(lines)
    texts[12] = "\u0627" * (STRETCH + 5) + "\nb only here"
    spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    made = {"at0": "", "at1": MARKER}
    pages = {}
    for i, t in texts.items():
        first, rest = t.split("\n", 1)
        at, start = i % 13, i * 37 % len(t)
        damaged = t[:start] + t[start : start + STRETCH].translate(str.maketrans("aei", "eia")) + t[start + STRETCH :]
        pages[f"doc_{i:012d}"] = t, made.get(f"at{at}", (t[:60] + "\n") * 12 if at == 2 else rest + "\n" + first if at == 3 else damaged)
    return folder, pages


def test_pages_are_whole(spark, long_texts):
    folder, pages = long_texts
    rows = {r["page_id"]: r for r in entry.queries()["page_char_edits"](spark, folder).collect()}
    assert {k: (r["char_edits"], r["ref_chars"]) for k, r in rows.items()} == {k: (slow_edits(a, b), len(a)) for k, (a, b) in pages.items()}
    results = {r["page_id"]: r["metrics"]["strict"] for r in entry.queries()["page_results"](spark, folder).collect()}
    assert {k: (m["char_edits"], m["word_edits"]) for k, m in results.items()} == {k: (slow_edits(a, b), slow_edits(a.split(), b.split())) for k, (a, b) in pages.items()}
    totals = defaultdict(int)
    for k, (a, b) in pages.items():
        totals["gold_scans" if int(k[4:]) % 10 == 1 else "synthetic_heldout"] += slow_edits(a, b)
    assert {r["split"]: r["char_edits"] for r in entry.queries()["split_summary"](spark, folder).collect()} == totals


def test_word_edits_are_whole(spark, long_texts):
    folder, pages = long_texts
    rows = {r["page_id"]: (r["word_edits"], r["ref_words"]) for r in entry.queries()["page_word_edits"](spark, folder).collect()}
    assert rows == {k: (slow_edits(a.split(), b.split()), len(a.split())) for k, (a, b) in pages.items()}
    assert max(n for _, n in rows.values()) > 30


def test_edits_throughout(spark):
    """Every document of the smallest tables, errors in all parts, against a plain table of distances."""
    import re

    import numpy as np

    def plain(a, b):
        a, b = (np.unique(np.array([*a, *b, ""], object).astype(str), return_inverse=True)[1][part] for part in (slice(0, len(a)), slice(len(a), len(a) + len(b))))
        places, row = np.arange(len(b) + 1), np.arange(len(b) + 1)
        for i, x in enumerate(a):
            best = np.minimum(row[1:] + 1, row[:-1] + (b != x))
            row = np.minimum.accumulate(np.r_[i + 1, best] - places) + places
        return int(row[-1])

    sf = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in entry.queries()["page_edits_throughout"](spark, sf).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert set(rows) == set(texts)
    for k, t in texts.items():
        other = re.sub("(?s)(.{49})(.)", lambda m: m[1] + ("#", "", m[2] + "#")[k % 3], t)
        if len(t) < 6000:
            assert rows[k]["char_edits"] == plain(t, other)
        assert len(t) // 50 * 0.5 <= rows[k]["char_edits"] <= len(t) // 50
        assert rows[k]["word_edits"] == plain(t.split(), other.split())


def test_full_word_edits(spark, long_texts):
    """Errors all over the texts, not in one stretch."""
    folder, pages = long_texts
    rows = {f"doc_{r['doc_id']:012d}": (r["word_edits"], r["words"]) for r in entry.queries()["page_word_edits_full"](spark, folder).collect()}
    swapped = {k: t.translate(str.maketrans("ae", "ea")) for k, (t, _) in pages.items()}
    assert rows == {k: (slow_edits(t.split(), swapped[k].split()), len(t.split())) for k, (t, _) in pages.items()}


def test_split_levels(spark, long_texts):
    """All rates of a split, from distances counted one by one at each level."""
    folder, pages = long_texts
    level = {"strict": lambda t: t, "diacritic_insensitive": text.bare_of, "skeleton": text.skeleton_of}
    for r in entry.queries()["split_levels"](spark, folder).collect():
        mine = [v for k, v in pages.items() if (int(k[4:]) % 10 == 1) == (r["split"] == "gold_scans")]
        for name, f in level.items():
            got = [(slow_edits(f(a), f(b)), len(f(a)), slow_edits(f(a).split(), f(b).split()), len(f(a).split()), f(a) == f(b)) for a, b in mine]
            n = len(got)
            assert r[f"{name}_cer_micro"] == pytest.approx(sum(x[0] for x in got) / sum(x[1] for x in got))
            assert r[f"{name}_wer_micro"] == pytest.approx(sum(x[2] for x in got) / sum(x[3] for x in got))
            assert r[f"{name}_cer_macro"] == pytest.approx(sum(x[0] / x[1] for x in got) / n)
            assert r[f"{name}_wer_macro"] == pytest.approx(sum(x[2] / x[3] for x in got) / n)
            assert r[f"{name}_exact_match_rate"] == pytest.approx(sum(x[4] for x in got) / n)


def test_bootstrap(spark):
    """The exact resampling against a plain one; the scalable one against the same interval."""
    sf = "/root/testdata/sf0.001"
    deltas = {}
    for r in entry.queries()["page_deltas"](spark, sf).collect():
        deltas.setdefault(r["split"], []).append((r["page_id"], r["delta_cer"]))
    got = {r["split"]: r for r in entry.queries()["bootstrap_ci"](spark, sf).collect()}
    poisson = {r["split"]: r for r in entry.queries()["bootstrap_poisson"](spark, sf).collect()}
    assert set(got) == set(poisson) == set(deltas)
    for split, rows in deltas.items():
        d, draw = [x for _, x in sorted(rows)], random.Random(THRESHOLDS["bootstrap_seed"])
        means = sorted(sum(d[int(draw.random() * len(d))] for _ in d) / len(d) for _ in range(10_000))
        assert (got[split]["n"], got[split]["ci_low"], got[split]["ci_high"]) == (len(d), pytest.approx(means[250], abs=1e-12), pytest.approx(means[9750], abs=1e-12))
        if len(d) > 10:
            spread = means[9750] - means[250]
            assert abs(poisson[split]["ci_low"] - means[250]) <= 0.25 * spread + 1e-9 and abs(poisson[split]["ci_high"] - means[9750]) <= 0.25 * spread + 1e-9


def test_negatives_by_hand(spark, long_texts):
    """Kinds and sources of unreadable pages, from the same hash written out."""
    folder, pages = long_texts
    sources = sorted(pages)

    def draw(what, name, n):
        h = xxhash.xxh64_intdigest(struct.pack("<i", 42), 42)
        for x in (what, name):
            h = xxhash.xxh64_intdigest(x.encode(), h)
        return (h - (1 << 64) if h >> 63 else h) % n

    rows = entry.queries()["negatives_sample"](spark, folder).collect()
    assert len(rows) == 100
    for r in rows:
        assert r["kind"] == UNREADABLE[draw("kind", r["page_id"], 3)] and r["source_image"] == f"images/{sources[draw('source', r['page_id'], len(sources))]}"
        assert (r["target"], r["image_path"]) == (MARKER, f"unreadable/{r['page_id']}.png")


def test_codepoint_diff(spark, long_texts):
    """The ten worst pages, place by place."""
    folder, pages = long_texts
    worst = sorted(pages, key=lambda k: (-slow_edits(*pages[k]) / len(pages[k][0]), k))[:10]
    rows = {r["page_id"]: r["differences"].split("\n") for r in entry.queries()["codepoint_diff"](spark, folder).collect()}
    assert sorted(rows) == sorted(worst)
    for k, said in rows.items():
        a, b = pages[k]
        places = [i for i in range(max(len(a), len(b))) if a[i : i + 1] != b[i : i + 1]]
        assert [int(x.split(":")[0]) for x in said[:40] if ":" in x] == places[:40]
        assert all(f"U+{ord(a[i]):04X}" in said[n] for n, i in enumerate(places[:40]) if i < len(a))
        assert (said[-1] == f"{len(places) - 40} more places differ") == (len(places) > 40)
