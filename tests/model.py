"""Small models for the tests, from the definitions in SURVEY §2."""

from __future__ import annotations

import bisect
import statistics
from collections import Counter
from fractions import Fraction


def bin_number(x, cutoffs):
    """Which of [c0, c1), [c1, c2), ... holds x."""
    return bisect.bisect_right(cutoffs, x) - 1


def check_windows(examples, data, B, T, C=1, cutoffs=(), bin_sizes=(), fixed=False):
    """Holds (w, r, ...) examples against the definition by arithmetic on stream positions.

    Token p of the first B * S sits in row p div S, column p mod S. Input i of window w in row r is position r*S + w*T + i and its
    label the next one. A tail-bin token's slot is its rank among the same window's, core's and bin's tokens.
    """
    S = len(data) // B
    steps = max(S - 1, 0)
    lengths = [min(T, steps - t) for t in range(0, steps, T)]
    lengths = [n for n in lengths if n == T or not fixed]
    assert sorted((e["w"], e["r"]) for e in examples) == [(w, r) for w in range(len(lengths)) for r in range(B)]
    for e in examples:
        first = e["r"] * S + e["w"] * T
        at = range(first, first + lengths[e["w"]])
        assert e["sample_id"] == e["w"] * B + e["r"]
        assert e["inputs"] == [data[p] for p in at] and e["labels"] == [data[p + 1] for p in at]
        if not (cutoffs and fixed):
            continue
        assert e["inp_mask"] == [int(bin_number(x, cutoffs) == 0) for x in e["inputs"]]
        assert e["tgt_mask"] == [int(bin_number(x, cutoffs) == 0) for x in e["labels"]]
        assert e["head_labels"] == [x if (b := bin_number(x, cutoffs)) == 0 else cutoffs[1] + b - 1 for x in e["labels"]]
        for side, shift in (("inp", 0), ("tgt", 1)):
            core = e["r"] // max(B // C, 1)
            ahead = Counter(bin_number(data[r * S + e["w"] * T + i + shift], cutoffs) for r in range(core * max(B // C, 1), e["r"]) for i in range(lengths[e["w"]]))
            for k, size in enumerate(bin_sizes):
                own = [i for i, p in enumerate(at) if bin_number(data[p + shift], cutoffs) == k + 1]
                pairs = [(i, ahead[k + 1] + j) for j, i in enumerate(own) if ahead[k + 1] + j < size]
                assert e[f"{side}_bins"][k] == (k, len(pairs), [x for pair in pairs for x in pair])


def bin_sizes(data, b, T, cutoffs, std_mult=(2.5, 2.5, 2.5)):
    """Capacities from the per-batch counts of each tail bin, over position arithmetic."""
    n = len(data) // b // T
    if not cutoffs or not n:
        return []
    counts = [[0] * n for _ in cutoffs[2:]]
    for p, x in enumerate(data[:b * n * T]):
        k = bin_number(x, cutoffs)
        if 1 <= k < len(cutoffs) - 1:
            counts[k - 1][p % (n * T) // T] += 1
    want = [statistics.fmean(c) + m * statistics.pstdev(c) for c, m in zip(counts, std_mult)]
    up = [-int(-round(w, 9) // 1) for w in want]
    return [max(8, 8 * int(Fraction(x, 8) + Fraction(1, 2))) for x in up]


def bpe(word, ranks):
    """Byte-pair merge by repeated search of the best-ranked pair (string splitting form)."""
    syms = list(word)
    while True:
        cands = [(ranks[(syms[i], syms[i + 1])], i) for i in range(len(syms) - 1) if (syms[i], syms[i + 1]) in ranks]
        if not cands:
            return syms
        r = min(cands)[0]
        pair = [k for k, v in ranks.items() if v == r][0]
        merged, i = [], 0
        while i < len(syms):
            if i + 1 < len(syms) and (syms[i], syms[i + 1]) == pair:
                merged.append(syms[i] + syms[i + 1])
                i += 2
            else:
                merged.append(syms[i])
                i += 1
        syms = merged
        if len(syms) == 1:
            return syms


def learn_merges(words, counts, num_merges):
    """Merge learning by full recount of all pairs after every merge."""
    from collections import Counter
    vocab = {tuple(w): c for w, c in zip(words, counts)}
    out = []
    for rank in range(num_merges):
        pairs = Counter()
        for w, c in vocab.items():
            for a, b in zip(w, w[1:]):
                pairs[(a, b)] += c
        if not pairs:
            break
        best = min(pairs.items(), key=lambda kv: (-kv[1], kv[0]))[0]
        out.append((rank, best[0], best[1]))
        nv = {}
        for w, c in vocab.items():
            res, i = [], 0
            while i < len(w):
                if i < len(w) - 1 and (w[i], w[i + 1]) == best:
                    res.append(w[i] + w[i + 1])
                    i += 2
                else:
                    res.append(w[i])
                    i += 1
            nv[tuple(res)] = nv.get(tuple(res), 0) + c
        vocab = nv
    return out
