import math
import random
import re
from collections import Counter

from tidegauge.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {r for r, n in Counter(runs).items() if n > 1}
    covered = {i + k for i, r in enumerate(runs) if r in twice for k in range(5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n)


def test_base_counts(spark, make, odd_rows):
    rng = random.Random(7)
    rows = [*odd_rows, *[(50 + i, " ".join(rng.choices("ab cd\n ef\t# gh|ij\x0b é𝒳  x".split(" "), k=rng.randint(0, 60))), "en", "a") for i in range(150)]]
    got = Q.verdicts(make(rows)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((r["doc_id"], *[r[c] for c in Q.BASE], r["base_failed"]) for r in got), key=key) == sorted(((r[0], *brute(r[1])) for r in rows), key=key)
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_limits_follow_the_group(spark, make):
    rng = random.Random(8)

    def text(share):
        return " ".join(("#" if rng.random() < share else "") + "".join(rng.choices("abcdefgh", k=5)) for _ in range(40))

    plain = [(i, text(0), "en", "plain") for i in range(150)]
    tagged = [(1000 + i, text(0.5), "en", "tagged") for i in range(150)]
    small = [(3000, text(0), "en", "tiny"), (3001, text(0), None, None)]
    strange = [(2000, text(1), "en", "plain"), (2001, text(0.55), "en", "tagged")]
    kept = {r["doc_id"] for r in Q.verdicts(make([*plain, *tagged, *small, *strange])).filter("kept").collect()}
    assert 2000 not in kept and 2001 in kept
    assert {r[0] for r in [*plain, *tagged, *small]} <= kept


def test_keeps_columns_and_empty_tables(spark, make, odd_rows):
    docs = make([*odd_rows, (99, "a b c d e f g h i j k l m n o p", "en", "a")])
    out = Q.keep_good(docs)
    assert out.columns == docs.columns and 99 in {r["doc_id"] for r in out.collect()}
    assert Q.verdicts(make([])).count() == 0 and Q.keep_good(make([])).count() == 0


def test_no_python_in_the_plan(spark, make):
    plan = Q.verdicts(make([(1, "a b c", "en", "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def brute_kept(rows, least=100, tail=20, reach=1):
    """The verdict of every row, by whole lists instead of sketches."""
    def shares(text):
        n, chars, symbols, lines, repeats, failed = brute(text)
        n_lines = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
        values = {"symbol_share": symbols / n if n else 0, "dup_line_share": lines / n_lines if n_lines else 0, "repeat_share": repeats / n if n else 0, "mean_word": chars / n if n else 0}
        return {m: math.ceil(math.log(v) / math.log(Q.STEP)) if v > 0 else None for m, v in values.items()}, failed

    seen = [(r, *shares(r[1])) for r in rows]
    out = []
    for r, own, failed in seen:
        fine = not failed
        for m, low_too in Q.MEASURES.items():
            for same in (lambda x: x[2:4] == r[2:4], lambda x: x[2] == r[2], lambda x: True):
                v = sorted(b[m] for x, b, f in seen if not f and b[m] is not None and same(x))
                if len(v) >= least:
                    break
            else:
                continue
            low, mid, high = (v[math.ceil(q * len(v) / 1000) - 1] for q in (tail, 500, 1000 - tail))
            if own[m] is not None:
                fine &= own[m] <= high + reach * max(high - mid, 1)
                fine &= not low_too or own[m] >= low - reach * max(mid - low, 1)
        out.append((r[0], fine))
    return out


def varied(n=700):
    rng = random.Random(9)
    letters = "abcdefgh"

    def text(k, strange):
        size, share = (3, 0.3) if k == "wild" else (1, 0.05)
        words = ["".join(rng.choices(letters, k=max(1, round(rng.gauss(5, size))))) + ("#" if rng.random() < share else "") for _ in range(rng.randint(5, 60))]
        if strange:
            words = [w * 3 + "#%" for w in words]
        lines = [" ".join(words[i : i + 8]) for i in range(0, len(words), 8)]
        return "\n".join(lines + lines[:1] * (rng.random() < 0.3))

    return [(100 + i, text(k, i % 40 == 0), rng.choice(["en", "en", "de", None]), k) for i in range(n) for k in [rng.choice(["wild", "calm", "calm", None])]]


def test_verdicts_equal_brute_force_and_do_not_depend_on_the_order(spark, make, odd_rows):
    rows = [*odd_rows[:4], *odd_rows[5:], *varied()]
    rows = [(r[0], r[1], r[2], r[3]) for r in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(brute_kept(rows), key=key)
    random.Random(3).shuffle(rows)
    for parts in (1, 7):
        assert sorted(((r["doc_id"], r["kept"]) for r in Q.verdicts(make(rows).repartition(parts)).collect()), key=key) == want
    failed = {r[0] for r in rows if brute(r[1])[5]}
    assert any(not k for i, k in want if i not in failed)


def test_limits_differ_by_source(spark, make):
    rows = {(r["group_lang"], r["group_source"]): r for r in Q.limits(Q.stored(Q.measure(make(varied())), "measures"), least=30).collect()}
    wild, calm = rows[("en", "wild")], rows[("en", "calm")]
    assert wild["mean_word_high"] > calm["mean_word_high"]
    for k, got in (("wild", wild), ("calm", calm)):
        seen = [brute(r[1]) for r in varied() if r[2:4] == ("en", k)]
        v = sorted(math.ceil(math.log(b[2] / b[0]) / math.log(Q.STEP)) for b in seen if b[2] and not b[5])
        mid, high = (v[math.ceil(q * len(v) / 1000) - 1] for q in (500, 980))
        assert len(v) >= 30 and got["symbol_share_high"] == high + max(high - mid, 1)
