"""Extractors for the tests: what they answer stands in the image."""

import json
import os

from folio.operators.extraction import ExtractionError


def count(task):
    """Attempts leave a mark, as they run in other processes."""
    folder = os.environ.get("FOLIO_TEST_CALLS")
    if folder:
        with open(f"{folder}/{task['page_number']}-{task['route']}-{task['attempt']}", "a") as f:
            f.write("x")


def answer(text):
    style = {"posture": "roman", "weight": "normal", "vertical_position": "baseline", "caps_style": "normal", "decorations": []}
    span = {"text": text, "language": "en", "source_typography": style, "semantic_line_break_after": False}
    block = {"role_hint": "paragraph", "content": [span], "dominant_language": "en", "heading_level_hint": None, "heading_role_hint": "unknown", "marker": None, "region": None, "alignment": None}
    return json.dumps({"page_kind_hint": "text", "dominant_language": "en", "printed_page_number": None, "blocks": [block], "warnings": []})


def free(image, task):
    count(task)
    text = image.decode()
    if text == "busy" and task["attempt"] < 3:
        raise ExtractionError("too many requests", status=429, retry_after=0.01)
    if text == "spent":
        raise ExtractionError("quota per day", status=429)
    if text == "bad":
        raise ExtractionError("no", status=400)
    if text == "recite":
        raise ExtractionError("declined", error="recitation")
    if text == "broken":
        return {"raw": "{}"}
    if text == "crash":
        raise KeyError("x")
    return {"raw": answer(text), "model": "m", "usage": {"total": 3}}


def paid(image, task):
    count(task)
    return {"raw": answer("paid " + image.decode())}


def read(image, task):
    return "Read line\n\n12"


def suggest(pages, task):
    """The first page says which is the cover; every page has a text."""
    text = [p["image"].decode() for p in pages]
    if "no answer" in text:
        raise ExtractionError("no", status=400)
    cover = next((int(t.split("=")[1]) for t in text if t.startswith("cover=")), None)
    return {"raw": json.dumps({"title": "T & " + task["book_id"], "authors": ["A"], "language": "en", "cover_page_number": cover, "title_page_number": pages[0]["page_number"], "warnings": [" see ", ""]})}


def jpeg(image):
    if image == b"spoilt":
        raise ValueError("spoilt")
    return b"jpeg of " + image


def size(image):
    width, height = image.decode().split("x")
    return int(width), int(height)


def crop(image, box):
    return f"{image.decode()} {box}".encode()
