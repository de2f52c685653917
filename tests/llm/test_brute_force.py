"""Inner parts of the trained operators against plain enumeration: posteriors, the composed grammar, decoding along the tree."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from polysift.llm import html_main, quality, toxicity
from polysift.llm.dom import Block


def strength(groups):
    """Moments of rows (n, rate, prior)."""
    spread = sum(n * (r - m) ** 2 for n, r, m in groups)
    noise, scale = sum(m * (1 - m) for _, _, m in groups), sum(n * m * (1 - m) for n, _, m in groups)
    between = (spread - noise) / max(scale, 1e-12)
    return float(np.clip(1 / max(between, 1e-9) - 1, *quality._STRENGTHS))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_posteriors_equal_plain_sums(spark, seed):
    """Every row's host and path rate, its own evidence left out, from all rows of a table."""
    r = random.Random(seed)
    rows = []
    for i in range(300):
        host = r.choice(["hot"] * 4 + ["", "a", "b", "c", f"h{i}"])
        rows.append((host, r.choice(["x", "y", ""]), r.choice([0.0, 1.0, round(r.random(), 3)]), r.gauss(0, 2)))
    df = spark.createDataFrame(rows, "host string, path string, own double, logit double").repartition(4)
    groups, prior = quality.posteriors(df.select("host", "path", F.col("own").alias("p")))
    got = quality._combined(df.join(groups, ["host", "path"]), prior).collect()

    total = sum(x[2] for x in rows)
    corpus = (total + 1) / (len(rows) + 2)
    of = lambda *keys: [x for x in rows if x[: len(keys)] == keys]
    hosts, paths = {x[0] for x in rows}, {x[:2] for x in rows}
    k = strength([(len(of(h)), sum(x[2] for x in of(h)) / len(of(h)), corpus) for h in hosts])
    parent = {h: (sum(x[2] for x in of(h)) + k * corpus) / (len(of(h)) + k) for h in hosts}
    kp = strength([(len(of(*q)), sum(x[2] for x in of(*q)) / len(of(*q)), parent[q[0]]) for q in paths])
    assert (prior["corpus"], prior["host_strength"], prior["path_strength"]) == pytest.approx((corpus, k, kp))
    want = []
    for i, (host, path, own, logit) in enumerate(rows):
        others = [x for j, x in enumerate(rows) if j != i]
        near, own_path = [x[2] for x in others if x[0] == host], [x[2] for x in others if x[:2] == (host, path)]
        host_rate = (sum(near) + k * corpus) / (len(near) + k)
        path_rate = (sum(own_path) + kp * host_rate) / (len(own_path) + kp)
        rate = min(max(path_rate, 1e-6), 1 - 1e-6)
        odds = logit + math.log(rate / (1 - rate)) - math.log(corpus / (1 - corpus))
        want.append((host, path, own, logit, host_rate, path_rate, 1 / (1 + math.exp(-odds))))
    shown = sorted((x.host, x.path, x.own, x.logit, x.host_rate, x.path_rate, x.probability) for x in got)
    for a, b in zip(shown, sorted(want), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=1e-9)


def apart(machine, symbols):
    """Factors of one machine alone."""
    state, step = machine
    out = []
    for s in symbols:
        state, factor = step(state, s)
        out.append(factor)
    return out


def test_composed_machine_equals_its_parts():
    """Every sequence of up to six symbols: the factors of the composition are the products of the machines' own."""
    machines = toxicity._negation(), toxicity._report(), toxicity._target()
    for length in range(1, 7):
        for symbols in itertools.product(range(6), repeat=length):
            state, factors = toxicity.START, []
            for s in symbols:
                state, factor = toxicity.MACHINE[state][s]
                factors.append(factor)
            parts = [apart(m, symbols) for m in machines]
            assert factors == pytest.approx([math.prod(x) for x in zip(*parts, strict=True)])


def test_clause_scores_equal_reading_word_by_word():
    """The scorer skips runs of other words; reading them one by one gives the same."""
    r = random.Random(7)
    words = {"bad*": (toxicity.INSULT, 1.5), "kill": (toxicity.THREAT, 2.0)}
    words |= {w: (s, 0.0) for s, ws in toxicity.FIXED.items() if s not in (toxicity.INSULT, toxicity.THREAT) for w in ws.split()[:2]}
    lexer = toxicity.Lexer(words)
    vocabulary = [w.rstrip("*").encode() for w in words] + [b"badly", b"other", b"word", b"x"] * 4
    machines = toxicity._negation(), toxicity._report(), toxicity._target()
    for _ in range(2_000):
        clause = [r.choice(vocabulary) for _ in range(r.randint(1, 30))]
        symbols = [lexer[w][0] if lexer[w] else toxicity.OTHER for w in clause]
        ahead = [math.prod(x) for x in zip(*(apart(m, symbols) for m in machines), strict=True)]
        back = apart(toxicity._target(), symbols[::-1])[::-1]
        want = sum(
            lexer[w][1] * f * (toxicity.TARGETED if b > 1 and f <= 1 else 1.0)
            for w, s, f, b in zip(clause, symbols, ahead, back, strict=True) if s in (toxicity.INSULT, toxicity.THREAT)
        )
        assert toxicity.clause_score(clause, lexer) == pytest.approx(want)


@pytest.mark.parametrize("n", [1, 2, 4, 6])
def test_decoded_labels_are_the_best_of_all_that_agree(n):
    """All labellings of small trees in which no child contradicts its ancestors."""
    drop, neutral, main = html_main.DROP, html_main.NEUTRAL, html_main.MAIN
    r = random.Random(n)
    for _ in range(60):
        blocks = [Block(-1, "html", [], 0, False, 0)] + [Block(r.randrange(i), "div", [], 1, r.random() < 0.15, 0) for i in range(1, n)]
        log_p = np.log(np.array([[r.random() + 1e-3 for _ in range(3)] for _ in range(n)]))

        def score(labels, blocks=blocks, log_p=log_p):
            total = log_p[0, neutral] if not blocks[0].hidden else -math.inf
            for i in range(1, len(blocks)):
                up, own = labels[blocks[i].parent], labels[i]
                if (up == drop and own != drop) or (up == main and own == neutral):
                    return -math.inf
                if blocks[i].hidden:
                    total += 0.0 if own == drop else -math.inf
                else:
                    total += log_p[i, own]
                total -= html_main.SWITCH if up == main and own == drop else 0.0
            return total

        best = max(score((neutral, *rest)) for rest in itertools.product((drop, neutral, main), repeat=n - 1))
        found = html_main.decode(blocks, log_p)
        assert found[0] == neutral and score(tuple(found.tolist())) == pytest.approx(best)
