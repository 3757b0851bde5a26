"""NumPy operations on pixels, for use inside Arrow batches.

Difference hash, connected components, white balance, gamma and contrast-limited
equalisation follow their definitions. Decoders' own shrinking needs a vision
library and is left out, as is the enhancement network, whose weights are not
public here.
"""

from __future__ import annotations

import numpy as np


def shrink(gray: np.ndarray, width: int, height: int) -> np.ndarray:
    """Area-weighted resize of a gray image (each output pixel is the mean of the input area under it)."""
    h, w = gray.shape

    def weights(src: int, dst: int) -> np.ndarray:
        edges = np.arange(dst + 1) * src / dst
        lo, hi = edges[:-1, None], edges[1:, None]
        at = np.arange(src)[None, :]
        cover = np.clip(np.minimum(hi, at + 1) - np.maximum(lo, at), 0, None)
        return cover / cover.sum(axis=1, keepdims=True)

    return weights(h, height) @ gray.astype(float) @ weights(w, width).T


def interpolation(source: int, target: int) -> str:
    """``area`` when shrinking, else ``linear``, judged by width."""
    return "area" if target < source else "linear"


def dhash(gray: np.ndarray) -> int:
    """64-bit difference hash of a gray image as a signed number: 9 by 8 means, a bit where left is less than right."""
    small = np.rint(np.round(shrink(gray, 9, 8), 9))  # a mean that is half a level to nine digits is taken as half
    bits = (small[:, :-1] < small[:, 1:]).ravel()
    value = int("".join("1" if b else "0" for b in bits), 2)
    return value - (1 << 64) if value >> 63 else value


def components(mask: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """8-connected components of a mask: left, top, width, height, pixels, in order of their first pixel.

    Runs of each row are joined with touching runs of the row above by union-find.
    """
    parent: list[int] = []
    runs: list[tuple[int, int, int]] = []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    above: list[int] = []
    for y, row in enumerate(np.asarray(mask, dtype=bool)):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], row.view(np.int8), [0]))))
        here = []
        k = 0
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            i = len(runs)
            runs.append((y, a, b))
            parent.append(i)
            here.append(i)
            while k < len(above) and runs[above[k]][2] < a:
                k += 1
            j = k
            while j < len(above) and runs[above[j]][1] <= b:
                p, q = find(above[j]), find(i)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                j += 1
        above = here
    out: dict[int, list[int]] = {}
    for i, (y, a, b) in enumerate(runs):
        r = out.setdefault(find(i), [a, y, b, y + 1, 0])
        r[0], r[2], r[3], r[4] = min(r[0], a), max(r[2], b), y + 1, r[4] + b - a
    return [(x1, y1, x2 - x1, y2 - y1, n) for x1, y1, x2, y2, n in out.values()]


def mask_boxes(mask: np.ndarray, label: str, least: float = 0.0015, most: float = 0.6) -> list[tuple[str, float, float, float, float]]:
    """Normalised boxes of a mask's components whose share of pixels lies in [least, most]."""
    h, w = mask.shape
    return [(label, (x + bw / 2) / w, (y + bh / 2) / h, bw / w, bh / h) for x, y, bw, bh, n in components(mask) if least <= n / (w * h) <= most and bw / w > 1e-4 and bh / h > 1e-4]


def palette_boxes(rgb: np.ndarray, palette: dict[tuple[int, int, int], str], least: float = 0.0015, most: float = 0.6) -> list[tuple[str, float, float, float, float]]:
    """Boxes of every colour of a palette in a three-bit mask (each channel on above 127)."""
    on = np.where(rgb > 127, 255, 0)
    out = []
    for colour, label in palette.items():
        out += mask_boxes((on == np.array(colour)).all(axis=2), label, least, most)
    return out


def share_of(gray: np.ndarray, codes: list[int]) -> float:
    """Share of pixels whose code is among ``codes``."""
    return float(np.isin(gray, codes).mean()) if gray.size else 0.0


def white_balance(image: np.ndarray, percent: float = 0.5) -> np.ndarray:
    """Each channel stretched between its low and high levels, ``percent`` / 2 per cent of the pixels cut at either end."""
    out = np.empty_like(image)
    levels = np.arange(256)
    for c in range(image.shape[2]):
        below = np.cumsum(np.bincount(image[..., c].ravel(), minlength=256))
        tail = below[-1] * percent / 200
        low, high = np.searchsorted(below, (tail, below[-1] - tail))
        stretched = np.rint((levels - low) * (255.0 / max(high - low, 1)))
        out[..., c] = np.clip(stretched, 0, 255).astype(np.uint8)[image[..., c]]
    return out


def gamma(image: np.ndarray, value: float = 0.7) -> np.ndarray:
    """Gamma correction by a look-up table, exponent 1 / value, cut to whole numbers."""
    table = (((np.arange(256) / 255.0) ** (1 / value)) * 255).astype(np.uint8)
    return table[image]


def clahe(gray: np.ndarray, clip: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Contrast-limited adaptive histogram equalisation of a gray image.

    The image, mirrored at its right and lower edge to a multiple of ``tiles``, is
    cut into tiles by tiles. A tile's histogram is cut at ``clip`` times its mean
    height, what is cut off spread evenly over all levels, and its running sum
    maps levels; a pixel takes the bilinear mean of the maps of the four nearest
    tile centres.
    """
    height, width = gray.shape
    padded = np.pad(gray, ((0, -height % tiles), (0, -width % tiles)), mode="reflect" if min(gray.shape) > tiles else "edge")
    th, tw = padded.shape[0] // tiles, padded.shape[1] // tiles
    blocks = padded.reshape(tiles, th, tiles, tw).transpose(0, 2, 1, 3).reshape(tiles * tiles, th * tw)
    counts = np.stack([np.bincount(b, minlength=256) for b in blocks])
    limit = max(int(clip * th * tw / 256), 1)
    over = np.maximum(counts - limit, 0).sum(axis=1)
    counts = np.minimum(counts, limit) + (over // 256)[:, None]
    for row, rest in zip(counts, over % 256):  # what doesn't divide evenly goes to levels at even steps
        if rest:
            row[np.arange(0, 256, max(256 // rest, 1))[:rest]] += 1
    maps = np.clip(np.rint(np.cumsum(counts, axis=1) * (255.0 / (th * tw))), 0, 255).reshape(tiles, tiles, 256)

    def between(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = (np.arange(n) / size) - 0.5
        low = np.floor(at).astype(int)
        return np.clip(low, 0, tiles - 1), np.clip(low + 1, 0, tiles - 1), at - low

    y0, y1, fy = between(height, th)
    x0, x1, fx = between(width, tw)
    fy, fx = fy[:, None], fx[None, :]
    level = lambda ys, xs: maps[ys[:, None], xs[None, :], gray]
    mixed = (level(y0, x0) * (1 - fx) + level(y0, x1) * fx) * (1 - fy) + (level(y1, x0) * (1 - fx) + level(y1, x1) * fx) * fy
    return np.clip(np.rint(mixed), 0, 255).astype(np.uint8)


def resize(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """An image brought to a size: by area means when its width shrinks, else bilinear (see ``interpolation``)."""
    planes = image[..., None] if image.ndim == 2 else image
    if interpolation(image.shape[1], width) == "area":
        out = np.stack([shrink(planes[..., c], width, height) for c in range(planes.shape[2])], axis=-1)
    else:
        def places(src: int, dst: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at = np.clip((np.arange(dst) + 0.5) * src / dst - 0.5, 0, src - 1)
            low = np.floor(at).astype(int)
            return low, np.minimum(low + 1, src - 1), at - low

        y0, y1, fy = places(image.shape[0], height)
        x0, x1, fx = places(image.shape[1], width)
        fy, fx = fy[:, None, None], fx[None, :, None]
        p = planes.astype(float)
        out = (p[y0][:, x0] * (1 - fx) + p[y0][:, x1] * fx) * (1 - fy) + (p[y1][:, x0] * (1 - fx) + p[y1][:, x1] * fx) * fy
    out = np.clip(np.rint(out), 0, 255).astype(np.uint8)
    return out[..., 0] if image.ndim == 2 else out


def fitted(image: np.ndarray, out_w: int, out_h: int, mode: str = "crop", grey: int = 114) -> np.ndarray:
    """An image in the target geometry: the centred window of its aspect ratio, or scaled to fit and padded with ``grey``."""
    h, w = image.shape[:2]
    if mode == "pad":
        scale = min(out_w / w, out_h / h)
        small = resize(image, max(1, round(w * scale)), max(1, round(h * scale)))
        out = np.full((out_h, out_w, *image.shape[2:]), grey, dtype=np.uint8)
        top, left = (out_h - small.shape[0]) // 2, (out_w - small.shape[1]) // 2
        out[top : top + small.shape[0], left : left + small.shape[1]] = small
        return out
    ratio = out_w / out_h
    cw, ch = (round(h * ratio), h) if w / h > ratio else (w, round(w / ratio))
    left, top = (w - cw) // 2, (h - ch) // 2
    return resize(image[top : top + ch, left : left + cw], out_w, out_h)
