"""Exact links among the few documents that one task holds."""

MOST_BITS = 1 << 15     # of a parity mark


def parity(found) -> bytes:
    """Of each cell of hashes, whether the set has an odd number of them, in bits.

    Two sets differ in at least as many hashes as there are bits in which their marks differ.
    There are two to four cells for a hash, up to a bound.
    """
    import numpy as np
    bits = min(MOST_BITS, 1 << max(6, (2 * len(found)).bit_length()))
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def suspects(members: list, across: bool, percent: int):
    """Which members (label, slot, size, parity mark) may link with one of another label.

    Sets that link differ in (100 - percent) of 100 + percent of their joint size at most. With
    ``across``, partners are in another slot.
    """
    import numpy as np
    label, slot, size = (np.array([m[i] for m in members], np.int64) for i in range(3))
    width = np.array([len(m[3]) for m in members], np.int64)
    out = np.zeros(len(members), bool)

    def compare(x, marks, y, others):
        step = max(1, (1 << 20) // max(1, len(y) * marks.shape[1]))
        for at in range(0, len(x), step):
            some = x[at:at + step]
            odd = np.bitwise_count(marks[at:at + step, None, :] ^ others[None]).sum(
                axis=2, dtype=np.int64)
            apart = np.maximum(odd, np.abs(size[some][:, None] - size[y][None]))
            near = apart * (100 + percent) <= (100 - percent) * (
                size[some][:, None] + size[y][None])
            near &= label[some][:, None] != label[y][None]
            if across:
                near &= slot[some][:, None] != slot[y][None]
            out[some[near.any(axis=1)]] = True
            out[y[near.any(axis=0)]] = True

    def of(spots):
        return np.frombuffer(b"".join(members[i][3] for i in spots.tolist()), np.uint64).reshape(
            len(spots), -1)
    for w in np.unique(width).tolist():     # linked sets have equal widths or one step apart
        same, half = np.flatnonzero(width == w), np.flatnonzero(2 * width == w)
        marks = of(same)
        compare(same, marks, same, marks)
        if len(half):
            middle = marks.shape[1] // 2
            compare(same, marks[:, :middle] ^ marks[:, middle:], half, of(half))
    return out


def joined(members: list, across: bool, percent: int, every: bool) -> list:
    """Links (a, b) among members (cls, label, slot, set); with ``across``, between slots only.

    Unless ``every`` link is asked for, pairs that are connected already are skipped.
    """
    import numpy as np
    members = sorted(members, key=lambda m: len(m[3]))
    size = np.array([len(m[3]) for m in members], np.int64)
    slot = np.array([m[2] for m in members], np.int64)
    names = {label: i for i, label in enumerate(dict.fromkeys(m[1] for m in members))}
    group = np.array([names[m[1]] for m in members], np.int64)
    groups = len(names)
    whole = np.concatenate([m[3] for m in members])
    owner = np.repeat(np.arange(len(members)), size)
    _, spot, held = np.unique(whole, return_inverse=True, return_counts=True)
    order = np.argsort(spot, kind="stable")
    holders = owner[order]
    first = np.concatenate(([0], np.cumsum(held)))[:-1]
    ends = np.cumsum(size)
    links = []
    for i in range(1, len(members)):
        if groups == 1 and not every:
            break
        mine = spot[ends[i] - size[i]:ends[i]]
        mine = mine[held[mine] > 1]
        counts = held[mine]
        total = int(counts.sum())
        if not total:
            continue
        at = np.arange(total) + np.repeat(first[mine] - np.cumsum(counts) + counts, counts)
        common = np.bincount(holders[at], minlength=len(members))[:i]
        good = 100 * common >= percent * (size[:i] + size[i] - common)
        good &= common > 0
        if across:
            good &= slot[:i] != slot[i]
        for j in np.flatnonzero(good).tolist():
            if every or group[i] != group[j]:
                links.append((members[j][0], members[i][0]))
                if group[i] != group[j]:
                    group[group == group[j]] = group[i]
                    groups -= 1
    return links
