"""Lines that several documents share, against a plain version."""

import re
from collections import defaultdict

from perilscope.llm import line_dedup
from tests.llm.conftest import DOCUMENTS, ODD_TEXTS, prose, rows_of

EDGES = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), EDGES.sub("", line))


def brute(rows, points=10, least=2):
    """(doc_id, lines, dropped, text) of each row; documents without id are one document, after all others."""
    holders = defaultdict(set)
    cut = [(i, (text or "").split("\n")) for i, text in rows]
    for i, lines in cut:
        for line in lines:
            if len(key_of(line)) >= points:
                holders[key_of(line)].add(i)
    owner = {k: min(ids - {None}) for k, ids in holders.items() if len(ids) >= least and ids - {None}}
    found = []
    for i, lines in cut:
        kept = [line for line in lines if owner.get(key_of(line), i) == i]
        found.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return found


def as_rows(frame):
    return rows_of(frame, "doc_id", "n_lines", "n_dropped", "kept_text")


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in r))


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENTS)


def test_lines_match_brute_force(spark):
    notice = "All Rights Reserved here"
    rows = [(n, f"{prose(100 * n, 5)}\n{notice if n % 2 else notice.upper()}\n\n  {notice}\t\n{n % 3} is shared by some") for n in range(1, 40)]
    rows += [(100, "ten points\nninepoint\r\n\xa0ten points"), (101, "TEN POINTS\nNINEPOINT\nten points\n"), (102, "\xe9" * 10), (103, "\xe9" * 10 + "\r")]
    rows += [(104, "\xc9\xc9 other letters fold not"), (105, "\xe9\xe9 other letters fold not"), (-5, notice)]
    found = line_dedup.remove_repeated_lines(make(spark, rows))
    assert as_rows(found) == in_order(brute(rows))
    assert brute(rows)[1][2] > 0


def test_cold_and_hot_keys_agree(spark, monkeypatch):
    rows = [(n, "\n".join([f"line number {n // k} of {k}" for k in (1, 2, 5, 50)] + ["every document has this"])) for n in range(100)]
    want = in_order(brute(rows))
    for most in (1, 20, 10_000):
        monkeypatch.setattr(line_dedup, "HOT_KEYS", most)
        assert as_rows(line_dedup.remove_repeated_lines(make(spark, rows))) == want
    fewer = line_dedup.remove_repeated_lines(make(spark, rows), points=17, least=5)
    assert as_rows(fewer) == in_order(brute(rows, 17, 5))


def test_lines_of_odd_rows(spark, odd, nothing, clashing):
    found = line_dedup.remove_repeated_lines(odd)
    assert as_rows(found) == in_order(brute([(r[0], r[1]) for r in ODD_TEXTS]))
    assert line_dedup.remove_repeated_lines(nothing).count() == 0
    more = clashing.withColumnsRenamed({"rank": "_at", "value": "_gone", "label": "n_lines", "key": "_h"})
    kept = line_dedup.remove_repeated_lines(more)
    assert kept.columns == [c for c in more.columns if c not in line_dedup.RESULT] + list(line_dedup.RESULT)
    assert as_rows(kept) == as_rows(found) and {r["_gone"] for r in kept.collect()} == {"own value"}


def test_rows_without_id_own_nothing_and_repeats_are_one_document(spark):
    rows = [(None, "a line without id"), (None, "a line without id\nonly among those"), (None, "only among those")]
    rows += [(7, "a line without id\nfirst of seven"), (7, "first of seven"), (8, "first of seven")]
    found = as_rows(line_dedup.remove_repeated_lines(make(spark, rows)))
    assert found == in_order(brute(rows))
    assert (None, 2, 1, "only among those") in found and (7, 1, 0, "first of seven") in found and (8, 1, 1, "") in found
