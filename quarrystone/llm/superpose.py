"""Whether two sets of atoms can be laid on each other within a tolerance.

For a given pairing the smallest largest distance over all rotations and
shifts is enclosed from both sides: any motion gives an upper bound, and for
any weights of the atoms the least weighted mean square, which is solved in
closed form, a lower one. Weights are improved until one of the bounds decides.
Pairings are searched depth first over atoms whose distances to those already
paired agree, so no pairing that can hold is passed over.
"""

from __future__ import annotations

from itertools import permutations, product

import numpy as np

#: The bounds are brought together to this, in ångström; what lies closer to the tolerance counts as within.
RESOLUTION = 1e-7
#: Structures no wider than this many tolerances may have several best motions, so more starts are tried.
NARROW = 20


def best_motion(a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The proper rotation (and both centres) that carries b onto a with the least weighted mean square."""
    ca, cb = weights @ a, weights @ b
    u, _, vt = np.linalg.svd(((b - cb) * weights[:, None]).T @ (a - ca))
    flip = np.ones(3)
    flip[2] = np.sign(np.linalg.det(u) * np.linalg.det(vt))
    return (u * flip) @ vt, ca, cb


def _bounds(a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """(lower, upper bound of the smallest largest distance, b moved, squared distances) from weights that sum to 1."""
    r, ca, cb = best_motion(a, b, weights)
    moved = (b - cb) @ r + ca
    square = ((moved - a) ** 2).sum(axis=1)
    return float(np.sqrt(weights @ square)), float(np.sqrt(square.max())), moved, square


def _small_rotation(w: np.ndarray) -> np.ndarray:
    angle = np.linalg.norm(w)
    if angle < 1e-12:
        return np.eye(3)
    x, y, z = w / angle
    k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
    return np.eye(3) + np.sin(angle) * k + (1 - np.cos(angle)) * k @ k


def _sharpened(a: np.ndarray, moved: np.ndarray, scale: float, sharpness: float, steps: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """``moved`` moved on to lessen a smooth largest distance (log-sum-exp of squares), and the weights of the atoms there."""

    def value(points: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        off = points - a
        s = sharpness * (off**2).sum(axis=1) / scale**2
        top = s.max()
        e = np.exp(s - top)
        return (top + np.log(e.sum())) / sharpness, e / e.sum(), off

    f, w, off = value(moved)
    for _ in range(steps):
        centre = moved.mean(axis=0)
        x = moved - centre
        jac = np.zeros((len(a), 3, 6))  # of the distances, by rotation and shift
        jac[:, 0, 1], jac[:, 0, 2], jac[:, 1, 0], jac[:, 1, 2], jac[:, 2, 0], jac[:, 2, 1] = x[:, 2], -x[:, 1], -x[:, 2], x[:, 0], x[:, 1], -x[:, 0]
        jac[:, :, 3:] = np.eye(3)
        grads = 2 * np.einsum("nij,ni->nj", jac, off) / scale**2
        g = w @ grads
        h = 2 * np.einsum("n,nij,nik->jk", w, jac, jac) / scale**2 + sharpness * ((grads * w[:, None]).T @ grads - np.outer(g, g))
        step = -np.linalg.solve(h + 1e-9 * (np.trace(h) + 1e-9) * np.eye(6), g)
        if -(g @ step) < 1e-13:
            break
        for _ in range(30):
            tried = x @ _small_rotation(step[:3]).T + centre + step[3:]
            nf, nw, noff = value(tried)
            if nf <= f + 0.1 * (g @ step):
                break
            step = step / 2
        else:
            break
        moved, f, w, off = tried, nf, nw, noff
    return moved, w


def _starts(a: np.ndarray, b: np.ndarray, tolerance: float):
    """Rotations of b to begin from: none, and the turns of a cube for small structures."""
    yield b
    centre = b.mean(axis=0)
    if np.linalg.norm(b - centre, axis=1).max(initial=0) <= NARROW * tolerance and len(b) > 1:
        for order in permutations(range(3)):
            for signs in product((1.0, -1.0), repeat=3):
                turn = np.zeros((3, 3))
                turn[range(3), order] = signs
                if np.linalg.det(turn) > 0:
                    yield (b - centre) @ turn + centre


def within(a: np.ndarray, b: np.ndarray, tolerance: float) -> bool:
    """Whether some rotation and shift brings every b within ``tolerance`` of its a.

    Least squares first, which decides most cases; then the atoms that lie
    farthest gain weight, ever more sharply, until the bounds decide or are
    within RESOLUTION of each other.
    """
    n = len(a)
    even = np.full(n, 1 / n)
    low, high, moved, _ = _bounds(a, b, even)
    if high <= tolerance + RESOLUTION:
        return True
    if low > tolerance + RESOLUTION:
        return False
    for start in _starts(a, moved, tolerance):
        here = start
        for power in range(1, 13):
            here, w = _sharpened(a, here, tolerance, 4.0**power)
            if np.sqrt(((here - a) ** 2).sum(axis=1).max()) <= tolerance + RESOLUTION:
                return True
            low, high, _, _ = _bounds(a, b, w)
            if high <= tolerance + RESOLUTION:
                return True
            if low > tolerance:  # holds for every motion, whatever the start
                return False
    return False


def _may_pair(ea: np.ndarray, da: np.ndarray, eb: np.ndarray, db: np.ndarray, reach: float) -> np.ndarray:
    """Which atoms can be each other's: same element, and the sorted distances to the atoms of every element agree."""
    fits = ea[:, None] == eb[None]
    for e in np.unique(ea):
        sa, sb = np.sort(da[:, ea == e], axis=1), np.sort(db[:, eb == e], axis=1)
        for i in range(len(ea)):
            own = np.flatnonzero(fits[i])
            fits[i, own] = np.abs(sb[own] - sa[i]).max(axis=1) <= reach
    return fits


def _order(fits: np.ndarray, da: np.ndarray) -> list[int]:
    """Atoms to pair one after another: of few candidates, the first ones far apart and off one line."""
    rare = fits.sum(axis=1).astype(float)
    first = int(np.lexsort((-da.sum(axis=1), rare))[0])
    order, near = [first], da[first].copy()
    while len(order) < min(4, len(da)):
        score = rare / (1e-9 + near)
        score[order] = np.inf
        order.append(int(np.argmin(score)))
        near = np.minimum(near, da[order[-1]])
    rest = [int(i) for i in np.argsort(rare, kind="stable") if i not in order]
    return order + rest


def superposable(ea: np.ndarray, a: np.ndarray, eb: np.ndarray, b: np.ndarray, tolerance: float) -> bool:
    """Whether the atoms pair one to one within elements so that after one rotation and shift no pair is farther apart than ``tolerance``.

    Every pairing whose distances between atoms agree is tried: each distance
    moves by at most two tolerances if no atom moves by more than one.
    """
    n = len(a)
    if n != len(b) or n == 0 or sorted(ea) != sorted(eb):
        return False
    if (ea == eb).all() and within(a, b, tolerance):
        return True
    da, db = (np.linalg.norm(x[:, None] - x[None], axis=2) for x in (a, b))
    reach = 2 * (tolerance + RESOLUTION)
    fits = _may_pair(ea, da, eb, db, reach)
    if not fits.any(axis=1).all() or not fits.any(axis=0).all():
        return False
    order = _order(fits, da)
    chosen = np.empty(n, int)
    free = np.ones(n, bool)
    # per depth: the candidates still to be tried, and how the choices so far restrict every atom
    open_, allowed = [list(np.flatnonzero(fits[order[0]]))], [fits]
    while open_:
        depth = len(open_) - 1
        i = order[depth]
        if len(allowed) > depth + 1:  # back from below
            allowed.pop()
            free[chosen[depth]] = True
        if not open_[depth]:
            open_.pop()
            continue
        j = int(open_[depth].pop())
        chosen[depth] = j
        # atoms at one place are alike; one of them stands for all
        open_[depth] = [k for k in open_[depth] if db[j, k] > 0 or eb[j] != eb[k]]
        if depth == n - 1:
            if within(a[order], b[chosen], tolerance):
                return True
            continue
        if 3 <= depth <= 6 or depth == n // 2:  # mirror images and the like
            even = np.full(depth + 1, 1 / (depth + 1))
            if _bounds(a[order[: depth + 1]], b[chosen[: depth + 1]], even)[0] > tolerance + RESOLUTION:
                continue
        free[j] = False
        narrowed = allowed[depth] & (np.abs(da[i][:, None] - db[j][None]) <= reach) & free[None]
        left = order[depth + 1 :]
        choices = narrowed[left].sum(axis=1)
        if choices.min() == 0:
            free[j] = True
            continue
        if choices.max() == 1:  # the rest follows
            forced = narrowed[left].argmax(axis=1)
            if len(set(forced)) == len(forced) and within(a[order], b[[*chosen[: depth + 1], *forced]], tolerance):
                return True
            free[j] = True
            continue
        allowed.append(narrowed)
        open_.append(list(np.flatnonzero(narrowed[left[0]])))
    return False
