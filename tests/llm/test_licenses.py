import random

import pytest

from tributary.llm import licenses as li


def brute(text, templates, threshold=0.8):
    """All runs of lines whose first line does not come again."""
    lines = [li.words(x) for x in text.split("\n")]
    out = []
    for name, body in sorted(templates.items()):
        w = li.words(body)
        pairs = set(zip(w, w[1:]))
        best = None
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if b - 1 > a and lines[b - 1] == lines[a] and lines[a]:
                    break
                flat = [x for line in lines[a:b] for x in line]
                value = li.dice(set(zip(flat, flat[1:])), pairs)
                if pairs and value >= threshold - 1e-12 and (best is None or (-value, b - a, a) < (-best[0], best[2] - best[1], best[1])):
                    best = (value, a, b)
        if best:
            out.append((name, best))
    return out


def test_scanner_is_brute_force():
    r = random.Random(2)
    templates = {k: v for k, v in li.TEMPLATES.items() if len(v) < 250}
    scan, seen = li.Scanner(templates), 0
    for _ in range(300):
        lines = []
        for _ in range(r.randint(0, 7)):
            kind = r.random()
            w = r.choice(list(templates.values())).split()
            if kind < 0.5:
                at = r.randint(0, len(w))
                lines += [" ".join(w[:at]), " ".join(w[at:])]
            elif kind < 0.8:
                for _ in range(r.randint(0, 2)):
                    w[r.randrange(len(w))] = "other"
                lines.append(" ".join(w))
            else:
                lines.append(r.choice(["", "the software is", "unrelated words here"]))
        text = "\n".join(lines)
        found = [(n, (d, a, b)) for n, d, a, b in scan(text)]
        want = brute(text, templates)
        assert [(n, round(x[0], 9)) for n, x in found] == [(n, round(x[0], 9)) for n, x in want]
        seen += len(want)
    assert seen > 100


def test_whole_licenses_wrapped_and_within_a_text():
    scan = li.Scanner(li.TEMPLATES)
    for name, body in li.TEMPLATES.items():
        w = body.split()
        text = "some first line\n" + "\n".join(" ".join(w[k : k + 9]) for k in range(0, len(w), 9)) + "\nand a last one"
        found = {n: d for n, d, _, _ in scan(text)}
        assert found[name] > 0.99, name


def test_repeated_lines_are_fast():
    scan = li.Scanner(li.TEMPLATES)
    assert scan("Released under the MIT License.\n" * 20_000)[0][0] == "MIT-notice"


def test_within_a_long_line():
    scan = li.Scanner(li.TEMPLATES)
    r = random.Random(4)
    for name, body in li.TEMPLATES.items():
        filler = [" ".join(f"w{r.randrange(500)}" for _ in range(3 * len(body.split()) + 20)) for _ in range(2)]
        for text in (f"{filler[0]} {body} {filler[1]}", f"first\n{filler[0]} {body}\n{filler[1]}", f"{filler[0]} " + "\n".join(body.rsplit(" ", 2)) + f"\n{filler[1]}"):
            found = {n: (d, a, b) for n, d, a, b in scan(text)}
            assert found[name][0] > 0.99, name
        assert {n: (a, b) for n, _, a, b in scan(f"first\n{filler[0]} {body}\n{filler[1]}")}[name] == (1, 2)


def test_first_line_comes_again():
    own = "alpha beta\ngamma delta\nalpha beta\nepsilon zeta"
    assert li.Scanner({"own": own.replace("\n", " ")}, 1.0)(own)[0][1:] == (1.0, 0, 4)


def test_repeated_words_of_a_line_are_fast():
    scan = li.Scanner(li.TEMPLATES)
    assert scan("some words before it that are of no use here at all " + "Released under the MIT License. " * 20_000)[0][0] == "MIT-notice"


@pytest.mark.parametrize("which", ["nasty", "clashing"])
def test_edge_cases(request, which, empty):
    df = request.getfixturevalue(which)
    rows = li.scan(df).collect()
    assert len(rows) == df.count() and not any(r["found"] for r in rows)
    assert li.scan(empty).collect() == []


def test_templates_of_a_table(spark):
    """In one block or in many, with nulls, shared names, repeated rows and null ids, the matches are the same."""
    rows = [("own", "a very own license text of mine"), (None, "x y"), ("none", None), ("other", "another license altogether it is"), ("own", "this is the second text of that name"), ("empty", "")]
    table = spark.createDataFrame(rows, "license string, text string").coalesce(1)
    texts = [(1, "A VERY own license, text of mine!"), (2, "nothing"), (None, "x\nthis is the second text of that name"), (3, "another license altogether it is\na very own license text of mine"), (3, "another license altogether it is\na very own license text of mine"), (4, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    want = [(1, ["own:0:1"]), (2, []), (3, ["other:0:1", "own:1:2"]), (3, ["other:0:1", "own:1:2"]), (4, []), (None, ["own:1:2"])]
    for size in (1, 40, 4 << 20):
        found = [(r["doc_id"], [f"{m['license']}:{m['first_line']}:{m['end_line']}" for m in r["found"]]) for r in li.scan_table(docs, table, block_bytes=size).collect()]
        assert sorted(found, key=str) == sorted(want, key=str)
    assert li.scan_table(docs, table.limit(0)).where("size(found) > 0").count() == 0
