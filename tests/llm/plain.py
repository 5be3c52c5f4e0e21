"""Plain helpers of the tests."""


def brute_distance(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to a passage of ``text``, and where the first such passage ends."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    best = min(row)
    return best, row.index(best)
