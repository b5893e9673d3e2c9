"""Repeats inside marked articles against a plain version that holds all runs."""

import random
from collections import defaultdict

import pyarrow as pa
import pytest

from kerbside.llm import extract
from kerbside.llm import text as T

SCHEMA = "page_id long, url string, html string"
SHARE = "Share this article with friends on all your networks"


def words(rng, n):
    return " ".join(f"w{rng.randrange(100_000)}" for _ in range(n))


def page(blocks, tag="article"):
    return f"<nav>Home News</nav><{tag}>" + "".join(f"<p>{b}</p>" for b in blocks) + f"</{tag}>"


def found(spark, rows):
    got = defaultdict(set)
    for r in extract.main_text(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].add(r.text)
    return got


def runs(blocks):
    tokens = " ".join(blocks).lower().split()
    return [tuple(tokens[i : i + extract.RUN]) for i in range(len(tokens) - extract.RUN + 1)]


def covered(blocks, often):
    hit = [False] * len(" ".join(blocks).split())
    for i, run in enumerate(runs(blocks)):
        if run in often:
            hit[i : i + extract.RUN] = [True] * extract.RUN
    return hit


def plain(pages):
    """Texts of ``(page_id, host, blocks)`` by the rule, host by host."""
    out = {}
    for host in {h for _, h, _ in pages}:
        own = [(i, tuple(b)) for i, h, b in pages if h == host]
        least = max(extract.LEAST, -(-len({b for _, b in own}) // extract.ONE_IN))

        def often(rows, least=least):
            having = defaultdict(set)
            for i, b in rows:
                for run in runs(b):
                    having[run].add((i, b))
            return {run for run, x in having.items() if min(len({i for i, _ in x}), len({b for _, b in x})) >= least}

        first = often(own)
        last = often([(i, b) for i, b in own if 2 * sum(covered(b, first)) <= len(covered(b, first))]) & first
        for i, b in own:
            hit, kept = iter(covered(b, last)), []
            for block in b:
                if not all([next(hit) for _ in block.split()]):
                    kept.append(block)
            out[i, host] = "\n".join(kept or b)
    return out


def test_boilerplate_in_marked_articles_goes(spark):
    rng = random.Random(3)
    own = [[words(rng, 30), words(rng, 12)] for _ in range(9)]
    rows = [(i, "http://h.example/", page([a, SHARE, b], "main" if i % 2 else "article")) for i, (a, b) in enumerate(own)]
    copy = [words(rng, 40), words(rng, 20)]
    rows += [(20 + i, "http://copies.example/", page([f"copy{i}", *copy])) for i in range(4)]
    rows += [(30 + i, "http://copies.example/", page([words(rng, 50), copy[0]] if i else [words(rng, 50)])) for i in range(2)]
    rows += [(40 + i, "http://two.example/", page([words(rng, 20), SHARE])) for i in range(2)]  # too few
    rows += [(50, "http://again.example/", page([f"{SHARE} {words(rng, 9)}", SHARE])) for _ in range(4)]  # one page id
    got = found(spark, rows)
    for i, (a, b) in enumerate(own):
        assert got[i] == {f"{a}\n{b}"}
    for i in range(4):
        assert got[20 + i] == {"\n".join([f"copy{i}", *copy])}  # whole articles that are copied stay
    assert got[31].pop().endswith(copy[0])
    assert all(SHARE in t for i in (40, 41, 50) for t in got[i]) and len(got[50]) == 4


@pytest.mark.parametrize("slices", [8, 0])
def test_against_the_plain_version(spark, monkeypatch, slices):
    monkeypatch.setattr(extract, "SLICE", 200)
    monkeypatch.setattr(extract, "SLICES", slices * 10)
    rng = random.Random(8)
    notes = [words(rng, n) for n in (3, 6, 7, 9, 14, 25)]
    pages = []
    for host, n in (("a.example", 40), ("b.example", 12), ("c.example", 7), ("d.example", 3), ("e.example", 2)):
        articles = []
        for _ in range(n):
            if articles and rng.random() < 0.25:
                copied = list(rng.choice(articles))
                copied[rng.randrange(len(copied))] = words(rng, 8)
                articles.append(copied if rng.random() < 0.6 else list(rng.choice(articles)))
                continue
            blocks = [words(rng, rng.choice([1, 4, 8, 30])) for _ in range(rng.choice([1, 3, 6]))]
            for k, note in enumerate(notes):
                if rng.random() < (0.2, 0.3, 0.5, 0.35, 0.6, 0.3)[k]:
                    blocks.insert(rng.randrange(len(blocks) + 1), note if rng.random() < 0.8 else f"{words(rng, 1)} {note}")
            articles.append(blocks)
        pages += [(len(pages) + i, host, b) for i, b in enumerate(articles)]
    want = plain(pages)
    assert sum(want[i, h] != "\n".join(b) for i, h, b in pages) > 20
    rows = [(i, f"http://{h}/{i}", page(b)) for i, h, b in pages]
    got = found(spark, rows + rows[::3])
    assert got == {i: {text} for (i, _), text in want.items()}


@pytest.mark.parametrize("size", [1, 2, 5, 100])
@pytest.mark.parametrize("limit", [1, 1 << 20])
def test_no_part_hides_a_frequent_run(monkeypatch, size, limit):
    monkeypatch.setattr(T, "PIECE", limit)
    rng = random.Random(size)
    note = words(rng, extract.RUN)
    texts, want = [], set()
    for host, n, having in (("a", 1, 1), ("b", 9, 3), ("c", 4, 3), ("d", 30, 10), ("e", 30, 9), ("f", 3, 3)):
        for k in rng.sample(range(n), n):
            article = f"{words(rng, 10)} {note if k < having else ''}"
            texts += [(host, article)] * rng.choice([1, 1, 3])  # equal articles are neighbours
        want |= {host} if having >= max(extract.LEAST, n / extract.ONE_IN) else set()
    number = {t: i for i, (_, t) in enumerate(texts)}
    rows = pa.RecordBatch.from_pylist([{"host": h, "article": number[t], "text": t} for h, t in texts])
    packed = list(extract._squeezed(rows.slice(i, size) for i in range(0, len(texts), size)))
    run = int(extract._runs(pa.array([note]))[0][0])
    got = [r for b in extract._often_here(packed) for r in b.to_pylist()]
    hosts = {r["host"] for r in got if r["run"] == run}
    assert want == {"b", "c", "d", "f"} and want <= hosts
    if limit > 1:
        assert hosts - {"a", "f"} == want - {"f"} and len(got) < 100  # whole hosts' counts are final, others are at the ends only
