"""Plain forms of the string similarities, pair by pair, that the columns are held against."""


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def token_sort(a, b):
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    join = lambda words: " ".join(sorted(words))
    met, one, two = join(x & y), join(x - y), join(y - x)
    if met and (not one or not two):
        return 1.0
    lines = [f"{met} {one}".strip(), f"{met} {two}".strip()]
    # shared words first on both sides: they are matched as a whole
    gap = bool(met)
    common = len(met) + gap + lcs(one, two)
    best = 2 * common / (len(lines[0]) + len(lines[1]))
    return max([best, *[2 * len(met) / (len(met) + len(x)) for x in lines if met]])


def partial(a, b):
    if not a or not b:
        return float(a == b)
    cuts = lambda x, y: max(ratio(x, y[max(0, i) : i + len(x)]) for i in range(1 - len(x), len(y)))
    return max(cuts(x, y) for x, y in ((a, b), (b, a)) if len(x) <= len(y))


def weighted(a, b):
    if not a or not b:
        return 0.0
    q = max(len(a), len(b)) / min(len(a), len(b))
    if q < 1.5:
        return max(ratio(a, b), 0.95 * token_sort(a, b), 0.95 * token_set(a, b))
    x, y = set(a.split()), set(b.split())
    join = lambda words: " ".join(sorted(words))
    tokens = 1.0 if x & y else max(partial(join(a.split()), join(b.split())), partial(join(x - y), join(y - x)))
    scale = 0.9 if q <= 8 else 0.6
    return max(ratio(a, b), scale * partial(a, b), 0.95 * scale * tokens)
