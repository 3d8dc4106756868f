import random
import re

import pytest
from pyspark.sql import functions as F

from linepulse.llm import linededup as ld
from tests.llm.cases import docs, messy, sentence


def words(line):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w]


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    s = 0
    while s < min(len(a), len(b)) - p and a[-1 - s] == b[-1 - s]:
        s += 1
    return p + s >= max(len(a), len(b)) - 1


def plain(rows, min_words=5):
    lines = sorted({(r[0] is None, r[0] or 0, r[1], n) for r in rows if r[1] is not None
                    for n in range(r[1].count("\n") + 1)})
    seen, gone = [], {}
    for none, i, text, n in lines:
        w = words(text.split("\n")[n])
        if w:
            if any(w == x or (min(len(w), len(x)) >= min_words and one_edit(w, x)) for x in seen):
                gone.setdefault((none, i, text), set()).add(n)
            seen.append(w)
    out = []
    for r in rows:
        cut = gone.get((r[0] is None, r[0] or 0, r[1]), set())
        text = r[1] if r[1] is None else "\n".join(
            x for k, x in enumerate(r[1].split("\n")) if k not in cut)
        out.append((r[0], text, len(cut)))
    return sorted(out, key=repr)


def near_lines(seed):
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(5, 9)) for _ in range(12)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 4)):
            w = rng.choice(base).split()
            for _ in range(rng.randint(0, 2)):
                k = rng.randrange(len(w) + 1)
                how = rng.random()
                if how < .4 and k < len(w):
                    w[k] = rng.choice("xyz")
                elif how < .7:
                    w.insert(k, rng.choice(["x", "y", w[k - 1]]))
                elif len(w) > 5 and k < len(w):
                    del w[k]
            lines.append(("  " if rng.random() < .2 else "") + " ".join(w).capitalize())
            if rng.random() < .3:
                lines.append(rng.choice(["All rights reserved.", "x", "One two three Four", "one two three"]))
        rows.append((i, "\n".join(lines), "en", "s", 1))
    return rows


@pytest.mark.parametrize("rows", [near_lines(1), near_lines(2), messy()], ids=["near", "near2", "messy"])
def test_equals_brute_force(spark, rows):
    # ids are unique but for identical rows, so the text's hash decides no order
    df = docs(spark, rows).withColumn("N_removed", F.lit("clash")).withColumn("gone", F.lit(1))
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in ld.dedup_lines(df).collect()), key=repr)
    rows = [r for r in rows]
    assert got == plain(rows)


def test_group_of_many_lines_one_edit_apart(spark):
    base = [f"w{i}" for i in range(10)]
    rows = [(i, " ".join(base[:4] + [f"other{i}"] + base[5:]), "en", "s", 1) for i in range(300)]
    rows += [(1000 + i, " ".join(base[:k] + [f"more{i}"] + base[k:]), "en", "s", 1)
             for i, k in enumerate([0, 3, 10, 7])] + [(2000, " ".join(base), "en", "s", 1)]
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in ld.dedup_lines(docs(spark, rows)).collect()),
                 key=repr)
    assert got == plain(rows)


def test_documents_of_copied_lines_go(spark):
    line = "one two three four five six"
    rows = [(1, line, "en", "s", 27), (2, line + "\n\n", "en", "s", 29), (3, None, "en", "s", None),
            (4, "", "en", "s", 0), (5, line + "\nand a line of its own here", "en", "s", 55)]
    df = docs(spark, rows)
    kept = ld.keep_first_lines(df)
    assert kept.dtypes == df.dtypes
    got = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert got == {1: (line, 27), 3: (None, None), 4: ("", 0),
                   5: ("and a line of its own here", 26)}


def test_empty_table_and_bad_bound(spark):
    assert ld.dedup_lines(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        ld.dedup_lines(docs(spark, []), min_words=1)


def test_main_path_is_native(spark):
    plan = ld.dedup_lines(docs(spark, messy()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_copies_of_short_lines_go(spark):
    rows = [(1, "All rights reserved.\nfour words stand here\n \nMenu", "en", "s", 1),
            (2, "menu\n \nall  rights reserved.\nfour words stood here", "en", "s", 1),
            (3, "Menu", "en", "s", 4)]
    df = docs(spark, rows)
    got = sorted((r.doc_id, r.text, r.n_removed) for r in ld.dedup_lines(df).collect())
    assert got == [(1, rows[0][1], 0), (2, " \nfour words stood here", 2), (3, "", 1)]
    assert sorted(r.doc_id for r in ld.keep_first_lines(df).collect()) == [1, 2]
    kept = ld.dedup_lines(df, copy_words=ld.MIN_WORDS)
    assert all(r.n_removed == 0 for r in kept.collect())
