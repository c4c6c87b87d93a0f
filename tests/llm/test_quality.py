from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from merchlens.llm import quality as q
from tests.llm.conftest import frame, prose


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base = (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )
    if not words:
        return base, dict.fromkeys(q.RULES, False)
    chars = base[1]
    unspaced = len(re.findall("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]", text))
    ended = len(re.findall("[。！？]|[.!?…।॥؟۔።][\"'”’»)\\]]*(?=[\\x20\\x09-\\x0D]|\\Z)", text))
    units = max(base[0], unspaced / 2)
    ratio = {
        "symbols": base[2] / chars,
        "repeats": base[4] / base[0],
        "line_repeats": base[3] / len(lines),
        "exclamations": text.count("!") / chars,
        "capitals": sum(c.isupper() for c in text) / chars,
        "echoes": sum(a == b for a, b in zip(words, words[1:], strict=False)) / base[0],
        "open_lines": sum(x.rstrip(" \t\n\x0b\x0c\r")[-1] not in q.CLOSING for x in lines) / len(lines),
        "odd_length": abs(chars / base[0] - q.USUAL_LENGTH),
    }
    abstains = {
        "open_lines": ended * 30 >= units or (len(lines) >= 5 and units <= 12 * len(lines)),
        "odd_length": 2 * unspaced > chars,
    }
    votes = {n: ratio[n] > above and not abstains.get(n) for n, above in q.DEFECTS}
    return base, votes | {"prose": all(ratio[n] < below or abstains.get(n, False) for n, below in q.PROSE)}


def brute_chances(votes):
    """Two classes over single documents, no patterns."""
    share, rates = 0.1, {n: (0.1, 0.9) if n == "prose" else (0.3, 0.02) for n in q.RULES}

    def poor(v):
        odds = share / (1 - share)
        for n, (p, g) in rates.items():
            odds *= p / g if v[n] else (1 - p) / (1 - g)
        return odds / (1 + odds)

    for _ in range(q.ROUNDS):
        chance, before = [poor(v) for v in votes], [share, *(x for n in q.RULES for x in rates[n])]
        bad, good = sum(chance), len(votes) - sum(chance)
        share, fresh = (bad + 1) / (len(votes) + 10), {}
        for n in q.RULES:
            first = (0.1, 0.9) if n == "prose" else (0.3, 0.02)
            yes = sum(c for c, v in zip(chance, votes, strict=True) if v[n])
            of_all = sum(v[n] for v in votes)
            pair = ((yes + 10 * first[0]) / (bad + 10), (of_all - yes + 10 * first[1]) / (good + 10))
            if (pair[0] > pair[1]) == (n == "prose") and pair[0] != pair[1]:
                pair = ((of_all + 10 * sum(first)) / (len(votes) + 20),) * 2
            fresh[n] = tuple(min(0.95, max(0.001, x)) for x in pair)
        rates = fresh
        if max(abs(a - b) for a, b in zip(before, [share, *(x for n in q.RULES for x in rates[n])], strict=True)) < q.SETTLED:
            break
    return [poor(v) for v in votes]


def texts():
    good = [prose(i, 60 + i) for i in range(40)]
    line = prose(7, 12)
    return [
        *good,
        *(" ".join(w + "$$$" for w in prose(i, 80).split()) for i in range(6)),
        *(prose(i, 70).upper().replace(" ", "!! ") for i in range(5)),
        "\n".join([line] * 9),
        "\n \n".join([prose(1, 60), prose(1, 60), "end a b c end a b c"]),
        "a b a b a b " * 30,
        "x " * 100,
        "word word other other " * 20,
        "É" * 40 + "\x0b\x0c\r\t Straße naïve",
        "one two",
        "",
        None,
        " \n\t",
        (None, good[0]),
        (3, good[1]),
        "|".join(prose(2, 90).split()).replace("|", " | "),
        "long " + prose(9, 4000),
    ]


def test_brute_force(llm):
    docs = frame(llm, texts()).withColumn("n_words", F.lit("clash")).withColumn("v_prose", F.lit(1))
    judged = [brute(r.text) for r in docs.collect()]
    poor = brute_chances([v for _, v in judged])
    expected = []
    for row, (base, _), p in zip(docs.collect(), judged, poor, strict=True):
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        expected.append((repr(row.doc_id), *base, failed, not failed and p <= 0.5, round(p, 6)))
    got = [(repr(r[0]), *r[1:-1], round(r[-1], 6)) for r in q.judge(docs).collect()]
    assert sorted(got) == sorted(expected)
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(e[0] for e in expected if e[-2])


def test_empty_table(llm):
    assert q.judge(frame(llm, [])).count() == 0 and q.keep_good(frame(llm, [])).count() == 0


def votes_of(llm, counted):
    """One row per document from {names of the voting rules: documents}."""
    rows = [tuple(n in names.split() for n in q.RULES) for names, many in counted.items() for _ in range(many)]
    return llm.createDataFrame(rows, ", ".join(f"v_{n} boolean" for n in q.RULES))


def chances(llm, counted):
    voted = votes_of(llm, counted)
    share, rates = q.estimate(voted)
    out = voted.select(*voted.columns, q.posterior(share, rates).alias("poor")).distinct().collect()
    return {" ".join(n for n in q.RULES if r[f"v_{n}"]): r.poor for r in out}, share


JUNK = {"symbols": 40, "repeats exclamations capitals": 30, "repeats echoes": 30}


def test_a_vote_that_clean_documents_share_does_not_reject(llm):
    """A rule that votes on a fifth of the clean documents is worth little, alone and beside prose; the others stay worth much."""
    for common in ("open_lines", "repeats", "symbols"):
        poor, share = chances(llm, {"prose": 800, f"{common} prose": 200} | JUNK)
        assert poor[f"{common} prose"] < 0.5 and poor["prose"] < 0.01
        assert all(poor[names] > 0.9 for names in JUNK if names != common)
        assert 0.03 < share < 0.2


def test_abstentions_count(llm):
    """A rare defect rejects; nothing at all said is not enough."""
    poor, _ = chances(llm, {"prose": 900, "": 5, "capitals": 3, "prose echoes": 1} | JUNK)
    assert poor["capitals"] > 0.5 > poor[""] and poor[""] > poor["prose"]


def test_no_documents(llm):
    share, rates = q.estimate(votes_of(llm, {}))
    assert (share, rates) == (q.SHARE, q.first_rates())


def test_rates_keep_their_order():
    assert q.ordered("echoes", 0.1, 0.3, 0.2) == (0.2, 0.2) and q.ordered("prose", 0.3, 0.1, 0.2) == (0.2, 0.2)
    assert q.ordered("prose", 0.0, 1.0, 0.5) == (q.LEAST, q.MOST)


def rows_of(words, n):
    return "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))


def test_layout_of_clean_texts_is_no_defect(llm):
    """Hard-wrapped prose, lists and scripts without spaces stay; junk still goes.

    An endless run of plain words has one vote against it and one for it: it stays, as the worst of those that do.
    """
    bare = [w.strip(".,") for w in prose(90, 160).split()]
    han = ["".join(chr(0x4E00 + (7 * i * i + 31 * k) % 5000) for k in range(18)) for i in range(80)]
    clean = {
        100: rows_of(prose(80, 150).split(), 8),
        101: rows_of(bare, 5),
        102: "。\n".join(han) + "。",
        103: "\n".join(han),
    }
    endless, poor = {200: " ".join(bare)}, {201: rows_of([w + "$$$" for w in prose(91, 160).split()], 8)}
    docs = frame(llm, [*(prose(i, 60 + i) for i in range(40)), *clean.items(), *endless.items(), *poor.items()])
    kept = {r.doc_id for r in q.keep_good(docs).collect()}
    assert kept == {*range(40), *clean, *endless}
    judged = {r.doc_id: r.poor for r in q.judge(docs).where("kept").collect()}
    assert judged.keys() == kept and max(judged, key=judged.get) == 200
