"""The clean-up of whole pages against a plain loop over clusters and cells."""

import random

from vellum.operators import layout

LABELS = ["text", "text", "list_item", "code", "title", "formula", "caption", "picture", "table", "form", "key_value_region"]
SPECIAL = {"picture", "table", "form", "key_value_region", "document_index"}


def area(b):
    return max(0.0, b[2] - b[0]) * max(0.0, b[3] - b[1])


def common(a, b):
    return max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))


def share(a, b):
    return common(a, b) / area(a) if area(a) else 0.0


def around(boxes):
    return [min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes)]


def settle(clusters, area_most, sure):
    """Groups of overlapping clusters become their best member, which takes their cells."""
    group = {c["id"]: {c["id"]} for c in clusters}
    for a in clusters:
        for b in clusters:
            x = common(a["box"], b["box"])
            if a is not b and x > 0 and max(share(a["box"], b["box"]), share(b["box"], a["box"]), x / (area(a["box"]) + area(b["box"]) - x)) >= 0.8:
                joint = group[a["id"]] | group[b["id"]]
                for i in joint:
                    group[i] = joint
    by, out, seen = {c["id"]: c for c in clusters}, [], set()
    for c in clusters:
        if c["id"] in seen:
            continue
        seen |= group[c["id"]]
        members, best = [by[i] for i in sorted(group[c["id"]])], None

        def stands(m, members=members):
            for o in members:
                if o is m:
                    continue
                ratio = area(m["box"]) / area(o["box"])
                if m["label"] == "list_item" and o["label"] == "text" and abs(1 - ratio) < 0.2:
                    continue
                if m["label"] == "code" and share(o["box"], m["box"]) > 0.8:
                    continue
                if ratio <= area_most and o["conf"] - m["conf"] > sure:
                    return False
            return True

        for m in members:
            if stands(m) and (best is None or (area(m["box"]) > area(best["box"]) and best["conf"] - m["conf"] <= sure)):
                best = m
        best = best or members[0]
        best["cells"] = set().union(*(m["cells"] for m in members))
        out.append(best)
    return sorted(out, key=lambda c: c["id"])


def page_by_loops(clusters, cells, width, height):
    clusters = [dict(zip(("id", "label", "conf", "box"), c, strict=True), cells=set()) for c in clusters]
    last = max((c["id"] for c in clusters), default=-1)
    clusters = [c for c in clusters if c["conf"] >= layout.CONFIDENCE[c["label"]]]
    for c in clusters:
        c["label"] = "section_header" if c["label"] == "title" else c["label"]
    regular, special = [c for c in clusters if c["label"] not in SPECIAL], [c for c in clusters if c["label"] in SPECIAL]
    lost = []
    for i, box in enumerate(cells):
        best, most = None, 0.2
        for c in regular:
            if share(box, c["box"]) > most:
                best, most = c, share(box, c["box"])
        if best is None:
            lost.append(i)
        else:
            best["cells"].add(i)
    regular = [c for c in regular if c["cells"] or c["label"] == "formula"]
    regular += [{"id": last + 1 + k, "label": "text", "conf": 1.0, "box": list(cells[i]), "cells": {i}} for k, i in enumerate(lost)]
    for _ in range(3):
        for c in regular:
            if c["cells"]:
                c["box"] = around([cells[i] for i in c["cells"]])
        n = len(regular)
        regular = settle(regular, 1.3, 0.05)
        if len(regular) == n:
            break
    special = [c for c in special if not (c["label"] == "picture" and area(c["box"]) / (width * height) > 0.9)]
    for s in special:
        s["children"] = [c["id"] for c in regular if share(c["box"], s["box"]) > 0.8]
        held = [c for c in regular if c["id"] in s["children"]]
        s["cells"] = set().union(*(c["cells"] for c in held))
        if held and s["label"] in ("form", "key_value_region"):
            s["box"] = around([c["box"] for c in held])
    stay = settle([c for c in special if c["label"] == "picture"], 2.0, 0.3) + settle([c for c in special if c["label"] != "picture"], 2.0, 0.2)
    inside = {i for s in stay for i in s["children"]}
    final = {(c["id"], c["label"], c["conf"], *c["box"]) for c in [*stay, *(c for c in regular if c["id"] not in inside)]}
    kept = {(c["id"], i) for c in [*stay, *regular] for i in c["cells"]}
    return final, {(s["id"], i) for s in stay for i in s["children"]}, kept


def test_whole_pages_are_cleaned_as_by_a_plain_loop(spark):
    rng = random.Random(9)
    clusters, cells, expected = [], [], ([], [], [])
    for page in range(60):
        own, boxes = [], []
        for i in range(rng.randrange(0, 14)):
            if own and rng.random() < 0.4:  # nearly the box of another one
                l, t, r, b = (v + rng.randrange(-3, 4) for v in rng.choice(own)[3])
            else:
                l, t = rng.randrange(0, 80), rng.randrange(0, 80)
                r, b = l + rng.randrange(10, 60), t + rng.randrange(10, 40)
            own.append((i, rng.choice(LABELS), rng.randrange(40, 100) / 100, [float(l), float(t), float(max(r, l + 1)), float(max(b, t + 1))]))
        for _ in range(rng.randrange(0, 14)):
            l, t = rng.randrange(0, 110), rng.randrange(0, 110)
            boxes.append([float(l), float(t), float(l + rng.randrange(2, 30)), float(t + 6)])
        clusters += [(page, i, label, conf, *box) for i, label, conf, box in own]
        cells += [(page, i, *box, f"w{i}") for i, box in enumerate(boxes)]
        for out, found in zip(expected, page_by_loops(own, boxes, 150.0, 150.0), strict=True):
            out += [(page, *row) for row in found]
    pages = spark.createDataFrame([(p, 150.0, 150.0) for p in range(60)], "page_id long, width double, height double")
    box = "l double, t double, r double, b double"
    found = layout.postprocessed(spark.createDataFrame(clusters, f"page_id long, cluster_id long, label string, confidence double, {box}"), spark.createDataFrame(cells, f"page_id long, cell_ix long, {box}, text string"), pages)
    final, children, kept = ({tuple(r) for r in f.collect()} for f in found)
    assert final == set(expected[0]) and children == set(expected[1]) and kept == set(expected[2]) and len(children) > 20
