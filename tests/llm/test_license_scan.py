import random
import re

from paceline.llm import license_scan
from paceline.llm.license_scan import TEMPLATES, license_matches, seed_pairs, template_table


def pairs(text):
    w = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
    return set(zip(w[:-1], w[1:], strict=True))


def brute(rows, templates, t=0.8):
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        for k, unit in [*([(0, text or "")] if len(lines) > 1 else []), *enumerate(lines, 1)]:
            for name, body in templates:
                a, b = pairs(unit), pairs(body)
                if a and b and 2 * len(a & b) / (len(a) + len(b)) >= t - 1e-9:
                    best = max(out.get((i, k, name), (0, 0)), (2 * len(a & b) / (len(a) + len(b)), len(a)))
                    out[(i, k, name)] = best
    return out


def test_same_as_brute_force(docs, spark):
    rnd = random.Random(6)
    rows = [(0, None), (1, ""), (2, "one"), (3, "\n\n"), (None, "Released under the MIT License."), (4, "x y " * 50_000)]
    for i in range(10, 200):
        lines = []
        for _ in range(rnd.randrange(1, 5)):
            words = rnd.choice(TEMPLATES)[1].split() if rnd.random() < 0.6 else ["some", "other", "words", "here", "the", "License"]
            for _ in range(rnd.choice([0, 0, 1, 2])):
                words[rnd.randrange(len(words))] = rnd.choice(["the", "License", "x", ""])
            lines.append(rnd.choice([" ", "  ", " - "]).join(words))
        rows.append((i, "\n".join(lines)))
    rows.append(rows[-1])
    templates = [*TEMPLATES, ("none", ""), ("null", None), (None, "Released under the MIT License."), TEMPLATES[0]]
    both = license_matches(docs(rows), template_table(spark, templates)).collect()
    got = [r for r in both if r.first_part is None]
    found = {(r.doc_id, r.unit, r.license): (r.dice, r.n_bigrams) for r in got}
    want = brute(rows, [x for x in templates if x[0]])
    assert len(found) == len(got) and found.keys() == want.keys() and len(want) > 150
    assert all(abs(found[k][0] - want[k][0]) < 1e-9 and found[k][1] == want[k][1] for k in want)
    runs = {(r.doc_id, r.license, r.first_part, r.last_part): (r.unit, r.last_line, r.dice, r.n_bigrams) for r in both if r.first_part is not None}
    expected = brute_runs([r for r in rows if len(r[1] or "") < 10_000], [x for x in templates if x[0]])
    assert len(runs) == len(both) - len(got) and runs == expected


def test_empty_sides(docs, spark):
    assert license_matches(docs([]), template_table(spark)).collect() == []
    assert license_matches(docs([(1, "Released under the MIT License.")]), template_table(spark).limit(0)).collect() == []


def parts_of(text):
    """(line, words) of every part that has words."""
    out = []
    for line, raw in enumerate((text or "").split("\n"), 1):
        for piece in re.split(r"(?<=[.!?;:])[ \t]+", raw):
            words = re.sub(r"[\W_]+", " ", piece.lower()).split()
            out += [(line, words)] if words else []
    return out


def brute_runs(rows, templates, t=0.8):
    bodies = [(name, pairs(body)) for name, body in templates if pairs(body)]
    most = int(max(len(b) for _, b in bodies) * (2 - t) / t + 1e-9) + 1
    out = {}
    for i, text in rows:
        parts, hits = parts_of(text), {}
        lines = [line for line, _ in parts]
        for f in range(len(parts)):
            for z in range(f, len(parts)):
                words = [w for _, ws in parts[f:z + 1] for w in ws]
                if len(words) > most:
                    break
                a = set(zip(words[:-1], words[1:], strict=True))
                for name, b in bodies:
                    d = 2 * len(a & b) / (len(a) + len(b))
                    if d >= t - 1e-9:
                        hits[(name, f, z)] = max(hits.get((name, f, z), (0, 0)), (d, len(a)))
        for (name, f, z), (d, n) in hits.items():
            beaten = any(m == name and g <= z and y >= f and (e, g - y, -g) > (d, f - z, -f) for (m, g, y), (e, _) in hits.items())
            one_line = lines[f] == lines[z] and z - f + 1 == lines.count(lines[f])
            if not beaten and not one_line and z - f + 1 < len(parts):
                out[(i, name, f + 1, z + 1)] = (lines[f], lines[z], d, n)
    return out


GPL = TEMPLATES[5][1]


def wrapped(text, width):
    import textwrap
    return textwrap.fill(text, width)


def test_wrapped_and_embedded_notices_in_a_long_file(docs, spark):
    code = "\n".join(f"value_{k} = compute(item_{k}, other_{k})" for k in range(3000))
    comment = "\n".join(" * " + line for line in wrapped(GPL, 70).split("\n"))
    bsd = TEMPLATES[9][1].replace("BSD-style ", "BSD-style\n// ")
    rows = [(1, f"{code}\n/*\n{comment}\n */\n{code}"), (2, f"{code}\n// {bsd}\n{code}"),
            (3, f"We wrote this in May. It was hard! {GPL} Please read on; there is more."), (4, code),
            (5, f"{code}\n{comment}\n\n\n{comment}\n{code}"), (None, f"a b\n{comment}"), (5, f"{code}\n{comment}\n\n\n{comment}\n{code}")]
    got = [r for r in license_matches(docs(rows), template_table(spark)).collect() if r.first_part is not None]
    n = len(comment.split("\n"))
    assert sorted((r.doc_id or 0, r.license, r.unit, r.last_line) for r in got) == sorted([
        (1, "GPL-3.0", 3002, 3001 + n), (2, "BSD-3-Clause", 3001, 3002), (3, "GPL-3.0", 1, 1),
        (5, "GPL-3.0", 3001, 3000 + n), (5, "GPL-3.0", 3003 + n, 3002 + 2 * n), (0, "GPL-3.0", 2, 1 + n)])
    assert all(r.dice > 0.9 for r in got)


def test_runs_same_as_brute_force(docs, spark):
    rnd = random.Random(11)
    rows = []
    for i in range(120):
        pieces = []
        for _ in range(rnd.randrange(1, 5)):
            body = rnd.choice(TEMPLATES)[1].split() if rnd.random() < 0.7 else ["some", "other", "words.", "And", "the", "License;"]
            for _ in range(rnd.choice([0, 0, 1, 3])):
                body[rnd.randrange(len(body))] = rnd.choice(["the", "License.", "x\n", "", "\n\n", "!\t"])
            piece = " ".join(body)
            pieces.append(wrapped(piece, rnd.choice([20, 40, 70])) if rnd.random() < 0.6 else piece)
        rows.append((i, rnd.choice(["\n", " ", ". ", "\n--\n"]).join(pieces)))
    got = [r for r in license_matches(docs(rows), template_table(spark)).collect() if r.first_part is not None]
    runs = {(r.doc_id, r.license, r.first_part, r.last_part): (r.unit, r.last_line, r.dice, r.n_bigrams) for r in got}
    assert len(runs) == len(got) and runs == brute_runs(rows, TEMPLATES) and len(runs) > 60


def test_seeds_leave_no_match_without_one(docs, spark):
    rnd = random.Random(3)
    for name, body in TEMPLATES:
        seeds = seed_pairs([re.sub(r"[\W_]+", " ", body.lower()).strip()], 0.8)
        free = pairs(body) - set(seeds)
        assert seeds and len(free) < 2 / 3 * len(pairs(body)), name
    # More template bigrams than are broadcast: no seeds, the same runs.
    rows = [(k, "x y z\n" + wrapped(rnd.choice(TEMPLATES)[1], 30) + "\nend of it") for k in range(12)]
    with_seeds = {tuple(r) for r in license_matches(docs(rows), template_table(spark)).collect()}
    old, license_scan.BROADCAST_BIGRAMS = license_scan.BROADCAST_BIGRAMS, 0
    try:
        without = {tuple(r) for r in license_matches(docs(rows), template_table(spark)).collect()}
    finally:
        license_scan.BROADCAST_BIGRAMS = old
    assert with_seeds == without and len({r[0] for r in with_seeds}) == 12
