"""A bidirectional LSTM in numpy that labels the blocks of a page as main text or not."""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from math import log1p

import numpy as np

from statement_lake.llm.html_blocks import Block, Frame

#: Buckets of hashed path words and text words, width of their vectors, and of a direction's state.
PATH_BUCKETS, WORD_BUCKETS, WIDTH, STATE = 1 << 11, 1 << 11, 16, 20
#: Elements nearest to a block that its path vector is made of.
PATH_FRAMES = 24
NUMBERS = 8
#: Vectors that are summed at a time.
GATHERED = 1 << 18
#: Blocks of pages that are labelled together, about.
TOGETHER = 1 << 13


def _bucket(text: str, buckets: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % buckets


@lru_cache(maxsize=8192)
def _frame_ids(frame: Frame, role: str) -> tuple[int, ...]:
    """Buckets of a tag, of its words and of the words' beginnings; role: around or at the block."""
    names = [f"{role}<{frame.tag}"]
    for word in frame.words:
        names += [f"{role}.{word}", f"{role}~{word[:4]}"]
    return tuple(_bucket(name, PATH_BUCKETS) for name in names)


def path_ids(path: Sequence[Frame]) -> list[int]:
    near = path[-PATH_FRAMES:]
    ids = {i for frame in near for i in _frame_ids(frame, "in")}
    if near:
        ids.update(_frame_ids(near[-1], "at"))
    ids.add(0)
    return sorted(ids)


def word_ids(text: str) -> list[int]:
    crc = zlib.crc32
    return [crc(w) % WORD_BUCKETS for w in text.lower().encode("utf-8", "surrogatepass").split()] or [0]


def numbers(block: Block, at: int, many: int) -> list[float]:
    text = block.text
    size = len(text)
    words = text.count(" ") + 1
    ends = sum(map(text.count, ".!?,;:"))
    return [
        log1p(size) / 8, log1p(words) / 6, block.linked / size, float(block.links > 0),
        min(1.0, 10 * ends / size), float(text[-1] in ".!?…\"'»”"), at / many, log1p(many) / 6,
    ]


@dataclass
class Sequenced:
    """The blocks of a page as the network reads them."""

    paths: list[list[int]]
    words: list[list[int]]
    numbers: np.ndarray
    labels: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.paths)


def sequenced(blocks: Sequence[Block], labels: Sequence[int] | None = None) -> Sequenced:
    many = max(1, len(blocks))
    return Sequenced(
        [path_ids(b.path) for b in blocks],
        [word_ids(b.text) for b in blocks],
        np.array([numbers(b, i, many) for i, b in enumerate(blocks)], np.float32).reshape(-1, NUMBERS),
        None if labels is None else np.array(labels, np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Bags:
    """Mean vectors of bags of buckets."""

    def __init__(self, bags: Sequence[Sequence[int]]):
        sizes = np.fromiter(map(len, bags), np.int64, len(bags))
        self.ids = np.fromiter((i for bag in bags for i in bag), np.int64, int(sizes.sum()))
        self.starts = np.cumsum(sizes) - sizes
        self.row = np.repeat(np.arange(len(bags)), sizes)
        self.scale = (1 / np.sqrt(sizes)).astype(np.float32)[:, None]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.starts), vectors.shape[1]), np.float32)
        for at in range(0, len(self.ids), GATHERED):
            row = self.row[at : at + GATHERED]
            first = np.flatnonzero(np.diff(row, prepend=-1))
            out[row[first]] += np.add.reduceat(vectors[self.ids[at : at + GATHERED]], first, axis=0)
        return out * self.scale

    def back(self, vectors: np.ndarray, slope: np.ndarray) -> np.ndarray:
        out = np.zeros_like(vectors)
        np.add.at(out, self.ids, (slope * self.scale)[self.row])
        return out


def _run(x: np.ndarray, recur: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States (steps, pages, STATE) of one direction; x: the gates' inputs (steps, pages, 4 * STATE)."""
    steps, pages = x.shape[:2]
    h = np.zeros((pages, STATE), np.float32)
    c = np.zeros((pages, STATE), np.float32)
    out, kept = np.zeros((steps, pages, STATE), np.float32), []
    for t in range(steps):
        z = x[t] + h @ recur
        gates = _sigmoid(z[:, : 3 * STATE])
        i, f, o = gates[:, :STATE], gates[:, STATE : 2 * STATE], gates[:, 2 * STATE :]
        g = np.tanh(z[:, 3 * STATE :])
        before, c = c, f * c + i * g
        tanh_c = np.tanh(c)
        if keep:
            kept.append((h, before, i, f, o, g, tanh_c))
        h = o * tanh_c
        out[t] = h
    return out, kept


def _run_back(slope: np.ndarray, recur: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the gates' inputs and of recur."""
    steps, pages = slope.shape[:2]
    dz_all = np.zeros((steps, pages, 4 * STATE), np.float32)
    d_recur = np.zeros_like(recur)
    dh_next, dc = np.zeros((pages, STATE), np.float32), np.zeros((pages, STATE), np.float32)
    for t in range(steps - 1, -1, -1):
        h_before, c_before, i, f, o, g, tanh_c = kept[t]
        dh = slope[t] + dh_next
        dc = dc + dh * o * (1 - tanh_c * tanh_c)
        dz = np.concatenate(
            [dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - g * g)],
            axis=1,
        )
        dc = dc * f
        dz_all[t] = dz
        d_recur += h_before.T @ dz
        dh_next = dz @ recur.T
    return dz_all, d_recur


class Labeller:
    """Path vectors, word vectors and numbers of each block, read forwards and backwards."""

    def __init__(self, seed: int = 0):
        draw = np.random.default_rng(seed)
        inputs = 2 * WIDTH + NUMBERS

        def small(*shape: int, scale: float) -> np.ndarray:
            return draw.normal(0, scale, shape).astype(np.float32)

        self.values = {"path": small(PATH_BUCKETS, WIDTH, scale=0.3), "word": small(WORD_BUCKETS, WIDTH, scale=0.1)}
        for way in ("ahead", "back"):
            self.values[f"{way}_in"] = small(inputs, 4 * STATE, scale=0.3)
            self.values[f"{way}_recur"] = small(STATE, 4 * STATE, scale=0.2)
            bias = np.zeros(4 * STATE, np.float32)
            bias[STATE : 2 * STATE] = 1
            self.values[f"{way}_bias"] = bias
            self.values[f"{way}_out"] = small(STATE, scale=0.3)
        self.values["out_bias"] = np.zeros(1, np.float32)

    @staticmethod
    def _layout(pages: Sequence[Sequenced]) -> tuple[dict[str, np.ndarray], tuple[int, int]]:
        """Where each block lies on the grid (step, page), read forwards and backwards."""
        sizes = np.array([len(p) for p in pages])
        page = np.repeat(np.arange(len(pages)), sizes)
        ahead = np.arange(len(page)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return {"ahead": (ahead, page), "back": (sizes[page] - 1 - ahead, page)}, (int(sizes.max()), len(pages))

    def _score(self, pages: Sequence[Sequenced], keep: bool = False) -> tuple[np.ndarray, dict]:
        v = self.values
        paths, words = _Bags([b for p in pages for b in p.paths]), _Bags([b for p in pages for b in p.words])
        x = np.concatenate(
            [paths.of(v["path"]), words.of(v["word"]), np.concatenate([p.numbers for p in pages])], axis=1
        )
        where, (steps, many) = self._layout(pages)
        score = np.full(len(x), v["out_bias"][0], np.float32)
        held: dict = {"x": x, "paths": paths, "words": words, "where": where}
        for way in ("ahead", "back"):
            grid = np.zeros((steps, many, 4 * STATE), np.float32)
            grid[where[way]] = x @ v[f"{way}_in"] + v[f"{way}_bias"]
            states, kept = _run(grid, v[f"{way}_recur"], keep)
            mine = states[where[way]]
            score += mine @ v[f"{way}_out"]
            held[way] = (grid.shape, mine, kept)
        return score, held

    def slopes(self, pages: Sequence[Sequenced]) -> tuple[float, dict[str, np.ndarray]]:
        """Cross entropy per block, and its slope for every weight."""
        v = self.values
        score, held = self._score(pages, keep=True)
        labels = np.concatenate([p.labels for p in pages])
        p = _sigmoid(score)
        loss = -np.mean(labels * np.log(p + 1e-9) + (1 - labels) * np.log(1 - p + 1e-9))
        d = ((p - labels) / len(labels)).astype(np.float32)
        out = {"out_bias": np.array([d.sum()], np.float32)}
        dx = np.zeros_like(held["x"])
        for way in ("ahead", "back"):
            shape, mine, kept = held[way]
            out[f"{way}_out"] = mine.T @ d
            slope = np.zeros((*shape[:2], STATE), np.float32)
            slope[held["where"][way]] = d[:, None] * v[f"{way}_out"]
            dz, out[f"{way}_recur"] = _run_back(slope, v[f"{way}_recur"], kept)
            dz = dz[held["where"][way]]
            out[f"{way}_in"], out[f"{way}_bias"] = held["x"].T @ dz, dz.sum(axis=0)
            dx += dz @ v[f"{way}_in"].T
        out["path"] = held["paths"].back(v["path"], dx[:, :WIDTH])
        out["word"] = held["words"].back(v["word"], dx[:, WIDTH : 2 * WIDTH])
        return float(loss), out

    def fit(self, pages: Sequence[Sequenced], rounds: int, seed: int, together: int = 16, rate: float = 0.01) -> None:
        """Adam over pages in drawn order; pages of like length go together."""
        draw = np.random.default_rng(seed)
        pages = [p for p in pages if len(p)]
        first = {name: np.zeros_like(value) for name, value in self.values.items()}
        second = {name: np.zeros_like(value) for name, value in self.values.items()}
        step, whole = 0, rounds * -(-len(pages) // together)
        for _ in range(rounds):
            order = sorted(range(len(pages)), key=lambda i: (len(pages[i]) // 8, draw.random()))
            groups = [order[i : i + together] for i in range(0, len(order), together)]
            for g in draw.permutation(len(groups)).tolist():
                step += 1
                _, slopes = self.slopes([pages[i] for i in groups[g]])
                pace = rate * (1 - 0.9 * step / whole)
                for name, slope in slopes.items():
                    first[name] += 0.1 * (slope - first[name])
                    second[name] += 0.01 * (slope * slope - second[name])
                    own = first[name] / (1 - 0.9**step)
                    spread = np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6
                    self.values[name] -= pace * own / spread

    def probabilities(self, pages: Sequence[Sequenced]) -> list[np.ndarray]:
        """The probability of each block of each page to be main text."""
        found: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(pages[order[end]]) * (end + 1 - at) <= TOGETHER:
                end += 1
            some = [pages[i] for i in order[at:end]]
            score = _sigmoid(self._score(some)[0])
            for i, part in zip(order[at:end], np.split(score, np.cumsum([len(p) for p in some])[:-1])):
                found[i] = part
            at = end
        return found
