"""The whole pipeline against a plain-Python brute force on random inputs."""

import hashlib
import random

import pytest

from tagmeans import ClusterConfig, run_lines

LANGS = ("Java", "Scala", "PHP", "C#")


def random_lines(seed, n_q=160):
    rnd = random.Random(seed)
    lines, aid = [], 100_000
    for q in range(1, n_q + 1):
        tag = LANGS[rnd.randrange(len(LANGS))]
        lines.append(f"1,{q},,,{rnd.randint(-3, 3)},{tag}")
        if rnd.random() < 0.1:                       # duplicate question id
            lines.append(f"1,{q},,,{rnd.randint(-3, 3)},{tag}")
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 6])):
            lines.append(f"2,{aid},,{q},{rnd.randint(-10, 40)},")
            aid += 1
    for _ in range(5):                               # orphan answers, other types
        lines.append(f"2,{aid},,{n_q + 50},{rnd.randint(0, 9)}")
        lines.append(f"3,{aid + 1},,,1,Java")
        aid += 2
    rnd.shuffle(lines)
    return lines


def brute(lines, cfg):
    qs, ans = {}, {}
    for ln in lines:
        f = ln.rstrip(",").split(",")
        t, pid, score = int(f[0]), int(f[1]), int(f[4])
        if t == 1:
            qs[pid] = f[5]
        elif t == 2:
            ans.setdefault(int(f[3]), []).append(score)
    points = []   # (id, x, y)
    for qid, tag in qs.items():
        if qid in ans:
            points.append((qid, cfg.langs.index(tag) * cfg.lang_spread, max(0, max(ans[qid]))))
    if cfg.stratified:
        seeds = []
        for li in range(len(cfg.langs)):
            x = li * cfg.lang_spread
            mine = sorted((hashlib.md5(f"{cfg.seed}|{x}|{pid}".encode()).hexdigest(), pid, y)
                          for pid, px, y in points if px == x)
            seeds += [(x, y) for _, _, y in mine[:cfg.per_lang]]
    else:
        mine = sorted((hashlib.md5(f"{cfg.seed}|{pid}".encode()).hexdigest(), pid, x, y)
                      for pid, x, y in points)
        seeds = [(x, y) for _, _, x, y in mine[:cfg.kernels]]

    def closest(p, cs):
        best, bd = 0, float("inf")
        for i, c in enumerate(cs):
            d = float(p[0] - c[0]) ** 2 + float(p[1] - c[1]) ** 2
            if d < bd:
                best, bd = i, d
        return best

    def tdiv(a, b):
        return abs(a) // b * (1 if a >= 0 else -1)

    means, it = list(seeds), 1
    while True:
        groups = {}
        for _, x, y in points:
            groups.setdefault(closest((x, y), means), []).append((x, y))
        new = [(tdiv(sum(p[0] for p in groups[i]), len(groups[i])),
                tdiv(sum(p[1] for p in groups[i]), len(groups[i]))) if i in groups else m
               for i, m in enumerate(means)]
        dist = sum(float(a[0] - b[0]) ** 2 + float(a[1] - b[1]) ** 2 for a, b in zip(means, new))
        means = new
        if dist < cfg.eta or it >= cfg.max_iterations:
            break
        it += 1
    groups = {}
    for _, x, y in points:
        groups.setdefault(closest((x, y), means), []).append((x, y))
    out = []
    for g in groups.values():
        by_lang = {}
        for x, _ in g:
            by_lang[x] = by_lang.get(x, 0) + 1
        top_x = min(by_lang, key=lambda x: (-by_lang[x], x))
        ys = sorted(y for _, y in g)
        n = len(ys)
        med = ys[n // 2] if n % 2 else (ys[n // 2] + ys[n // 2 - 1]) // 2
        out.append((cfg.langs[top_x // cfg.lang_spread], by_lang[top_x] * 100.0 / n, n, med))
    return sorted(out), it


@pytest.mark.parametrize("seed,spread", [(1, 50000), (2, 50000), (3, 100), (4, 100)])
def test_pipeline_matches_brute_force(lines_df, seed, spread):
    cfg = ClusterConfig(langs=LANGS, kernels=8, lang_spread=spread, eta=1.0, max_iterations=40)
    lines = random_lines(seed)
    expect, updates = brute(lines, cfg)
    run = run_lines(lines_df(lines), cfg)
    got = sorted(tuple(r) for r in run.results().collect())
    assert got == expect
    assert run.result.updates == updates
