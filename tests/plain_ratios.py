"""The ratios in plain Python, to hold the column expressions against."""


def lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def in_order(s: str) -> str:
    return " ".join(sorted(s.split()))


def token_sort(a: str, b: str) -> float:
    return ratio(in_order(a), in_order(b))


def partial(a: str, b: str) -> float:
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 0.0 if long else 100.0
    return max(ratio(short, long[max(0, at):at + len(short)]) for at in range(1 - len(short), len(long)))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_x or not only_y):
        return 100.0
    xs, ys = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    return max([ratio(xs, ys)] + ([ratio(both, xs), ratio(both, ys)] if both else []))


def wratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    share = max(len(a), len(b)) / min(len(a), len(b))
    if share < 1.5:
        return max(ratio(a, b), 0.95 * token_sort(a, b), 0.95 * token_set(a, b))
    scale = 0.9 if share <= 8 else 0.6
    return max(ratio(a, b), scale * partial(a, b), 0.95 * scale * partial(in_order(a), in_order(b)))
