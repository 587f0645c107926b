"""Contraction of characters and bitmap regions against plain loops."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from vellum.operators import bitmaps, contraction
from vellum.plans import page_queries

SMALL = "/root/testdata/sf0.001"


def contracted_by_loops(cells, gap, space, same_font=True):
    """Three passes over all pairs with flags of what is still there; cells are dicts."""
    marks = set(" \t\n\r\f\v.,;:!?()[]{}'\"`‘’“”-–—_/\\|@#%&*+=<>")
    neutral = lambda t: len(t) == 1 and (t in marks or 0x2000 <= ord(t) <= 0x206F)
    dist = lambda a, i, b, j: math.dist((a[f"x{i}"], a[f"y{i}"]), (b[f"x{j}"], b[f"y{j}"]))
    near = lambda a, b, eps: dist(a, 1, b, 0) < eps and dist(a, 2, b, 3) < eps
    width = lambda a: dist(a, 0, a, 1) / len(a["text"]) if a["text"] else 0.0
    cells = [dict(c, n=1, there=True) for c in cells]

    def may(a, b):
        return a["there"] and b["there"] and not (same_font and a["font"] != b["font"]) and (a["ltr"] == b["ltr"] or neutral(a["text"]) or neutral(b["text"]))

    def take(a, b, least):
        far = " " if least < dist(a, 1, b, 0) else ""
        if a["ltr"] and b["ltr"]:
            a["text"] = a["text"] + far + b["text"]
        else:
            a["text"], a["ltr"] = b["text"] + far + a["text"], False
        for k in ("x1", "y1", "x2", "y2"):
            a[k] = b[k]
        a["n"] += b["n"]
        b["there"] = False

    for kind in ("on", "back", "both"):
        n = len(cells)
        for i in range(n) if kind != "back" else range(n - 1, -1, -1):
            if not cells[i]["there"]:
                continue
            for j in range(i + 1, n) if kind != "back" else range(i - 1, -1, -1):
                a, b = cells[i], cells[j]
                if not may(a, b):
                    break
                reach, least = width(a) * gap, width(a) * space
                if kind != "back" and near(a, b, reach):
                    take(a, b, least)
                elif kind != "on" and near(b, a, reach):
                    take(b, a, least)
                else:
                    break
        cells = [c for c in cells if c["there"]]
    return [tuple(c[k] for k in ("cell_ix", "font", "ltr", "text", *contraction.QUAD, "n")) for c in cells]


def line_of(rng, start, ltr):
    """Characters of a line in drawing order, with gaps, marks, turned stretches and a slope."""
    x, y, out = rng.uniform(0, 50), rng.uniform(0, 500), []
    slope = rng.choice([0, 0, 0.02])
    for k in range(rng.randrange(1, 25)):
        w = rng.choice([4.0, 5.0, 6.0, 0.0])
        out.append({"text": rng.choice(["a", "b", "É", "-", " ", ".", "שלום", ""]), "font": rng.choice(["f", "f", "f", "g"]), "ltr": ltr if rng.random() < 0.9 else not ltr,
                    "x0": x, "y0": y + slope * x, "x1": x + w, "y1": y + slope * (x + w), "x2": x + w, "y2": y + 9 + slope * (x + w), "x3": x, "y3": y + 9 + slope * x})
        x += w + rng.choice([0, 0, 0, 0.5, 1.5, 2.5, 4, 12])
    if not ltr or rng.random() < 0.3:
        out.reverse()
    return [dict(c, cell_ix=start + i) for i, c in enumerate(out)]


@pytest.mark.parametrize("kind", ["words", "lines"])
def test_contraction_is_that_of_three_passes_over_pairs(spark, kind):
    rng = random.Random(kind)
    pages = {}
    for page in range(120):
        cells = []
        for _ in range(rng.randrange(6)):
            cells += line_of(rng, len(cells), rng.random() < 0.7)
        pages[page] = cells
    rows = [dict(c, page_id=p) for p, cells in pages.items() for c in cells]
    found = getattr(contraction, kind)(spark.createDataFrame(pd.DataFrame(rows).astype({"cell_ix": "int64"}))).collect()
    expected = set()
    for p, cells in pages.items():
        kept = [c for c in cells if c["text"].strip()] if kind == "words" else cells
        gap, space = (0.33, 0.66) if kind == "words" else (1.0, 0.33)
        expected |= {(p, *c) for c in contracted_by_loops(kept, gap, space)}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    assert sum(r.n for r in found) == sum(bool(c["text"].strip()) or kind == "lines" for c in rows) and max(r.n for r in found) > 5


def boxed(text, x=0.0, ltr=True, width=5.0, ix=0):
    return {"page_id": 1, "cell_ix": ix, "font": "f", "ltr": ltr, "text": text, "x0": x, "y0": 0.0, "x1": x + width, "y1": 0.0, "x2": x + width, "y2": 9.0, "x3": x, "y3": 9.0}


def test_a_broken_word_and_a_line_from_right_to_left(spark):
    broken = [boxed(c, 5.0 * i, ix=i) for i, c in enumerate("co-")] + [boxed("op", 16.4, ix=3)]
    assert [r.text for r in contraction.words(spark.createDataFrame(broken)).collect()] == ["co-op"]
    letters = [boxed(c, 40 - 5.0 * i, ltr=c == "!", ix=i) for i, c in enumerate("אבג!")]
    assert {r.text for r in contraction.lines(spark.createDataFrame(letters)).collect()} == {"אבג!"}
    apart = [boxed("a", 0, ix=0), boxed("b", 7, ix=1), boxed("c", 30, ix=2)]
    assert [r.text for r in contraction.lines(spark.createDataFrame(apart)).collect()] == ["a b", "c"]
    assert contraction.lines(spark.createDataFrame(apart).limit(0)).count() == 0


def test_no_character_of_a_page_is_lost(spark):
    chars = page_queries.characters(spark, SMALL)
    found = page_queries.cells_to_lines(spark, SMALL)
    count = lambda df: sorted("".join(r.text.split()) for r in df.select("text").collect())
    assert sorted("".join(count(chars))) == sorted("".join(count(found))) and found.count() < chars.count() / 3


# -- bitmaps -------------------------------------------------------------------------------------


def regions_by_flood(boxes, width, height):
    """Draw, dilate and flood pixel by pixel."""
    drawn = {(x, y) for l, t, r, b in boxes for x in range(max(l, 0), min(r, width - 1) + 1) for y in range(max(t, 0), min(b, height - 1) + 1)}
    grown = {(x + i, y + j) for x, y in drawn for i in range(-10, 10) for j in range(-10, 10) if 0 <= x + i < width and 0 <= y + j < height}
    left, out = set(grown), []
    for y in range(height):
        for x in range(width):
            if (x, y) in left:
                stack, part = [(x, y)], {(x, y)}
                left.discard((x, y))
                while stack:
                    i, j = stack.pop()
                    for near in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
                        if near in left:
                            left.discard(near)
                            part.add(near)
                            stack.append(near)
                xs, ys = [p[0] for p in part], [p[1] for p in part]
                out.append((len(out), min(xs), min(ys), max(xs), max(ys), len(part)))
    return out, len(grown)


def test_regions_are_those_of_a_flood_fill():
    rng = random.Random(1)
    for _ in range(25):
        width, height = rng.randrange(30, 90), rng.randrange(30, 90)
        boxes = []
        for _ in range(rng.randrange(6)):
            l, t = rng.randrange(-20, width + 10), rng.randrange(-20, height + 10)
            boxes.append((l, t, l + rng.randrange(-1, 12), t + rng.randrange(0, 12)))
        found = bitmaps.regions(*bitmaps.covered(np.array(boxes, dtype=np.int64).reshape(-1, 4), width, height))
        expected, pixels = regions_by_flood([b for b in boxes if b[0] <= b[2] and b[1] <= b[3]], width, height)
        assert found == expected and sum(p for *_, p in found) == pixels


def test_coverage_decides_what_is_read(spark):
    pages = spark.createDataFrame([(1, 100.0, 100.0), (2, 100.0, 100.0), (3, 100.0, 100.0), (4, 100.0, 100.0)], "page_id long, width double, height double")
    rects = spark.createDataFrame([(1, 0.0, 0.0, 99.0, 80.0), (2, 20.0, 20.0, 30.0, 30.0), (2, 80.0, 80.0, 85.4, 85.6), (3, 0.0, 0.0, 0.0, 0.0)], "page_id long, l double, t double, r double, b double")
    found = bitmaps.ocr_boxes(rects, pages)
    assert {tuple(r) for r in found.select("page_id", "whole", *"ltrb").collect()} == {(1, True, 0, 0, 100, 100), (2, False, 10, 10, 39, 39), (2, False, 70, 70, 94, 95)}
    assert bitmaps.ocr_boxes(rects, pages, full_page=True).where("whole").count() == 4
    assert {r.page_id for r in bitmaps.ocr_boxes(rects, pages, threshold=0.2).collect()} == {1}
    assert bitmaps.ocr_boxes(rects.limit(0), pages).count() == 0
