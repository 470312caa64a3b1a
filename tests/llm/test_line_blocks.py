"""Blocks of lines that share a key: what is told apart without working out edits."""

import random

import numpy as np

from chainloom.llm import line_dedup


def _linked(lines, links):
    of = list(range(len(lines)))
    for a, b in links:
        x, y = of[a], of[b]
        of = [min(x, y) if z in (x, y) else z for z in of]
    return of


def test_lines_that_repeat_few_words_need_no_edits(monkeypatch):
    rng, lines = random.Random(7), []
    for _ in range(150):  # runs of words, of a small vocabulary
        run = rng.randint(8, 40)
        lines.append([w for w in rng.sample(range(40), 8) for _ in range(run)])
    for _ in range(30):  # and copies with a few edits
        line = list(rng.choice(lines[:150]))
        for _ in range(len(line) // 12):
            line[rng.randrange(len(line))] = rng.randrange(40)
        lines.append(line)
    alike = [(i, j) for j in range(len(lines)) for i in range(j) if line_dedup.edits(lines[i], lines[j]) <= 20 * max(len(lines[i]), len(lines[j])) // 100]
    calls, plain = [], line_dedup.edits
    monkeypatch.setattr(line_dedup, "edits", lambda a, b, *most: calls.append(1) or plain(a, b, *most))
    block, links = line_dedup.Block(80), []
    for i, line in enumerate(lines):
        links += block.add(i, np.array(line, np.uint32), i)
    assert _linked(lines, links) == _linked(lines, alike)
    assert len(calls) < 5 * len(lines)  # of 16,110 pairs


def test_edits_end_early_above_the_most():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(0, 40))] for _ in range(2))
        exact, most = line_dedup.edits(a, b), rng.randint(0, 20)
        found = line_dedup.edits(a, b, most)
        assert found == exact if exact <= most else found > most
