"""A second way to the same results: apply events to rows one at a time.

Plain dictionaries, no Spark. It serves to check the aggregates on small cases.
"""

from __future__ import annotations

import json

TAGS = ("title", "author", "date", "sector")


class Failure(Exception):
    pass


def _tagger_answer(text):
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return None


def _text(v):
    return None if v is None else v if isinstance(v, str) else json.dumps(v)


class Batch:
    """Working rows; writes reach all rows of a link, reads look at the first."""

    def __init__(self, rows):
        self.rows = [dict(r, status="unprocessed", uncertainty=None) for r in rows]
        self.archive = []

    def of(self, url):
        return [r for r in self.rows if r["pdf_link"] == url]

    def put(self, url, **values):
        for r in self.of(url):
            r.update(values)
        return bool(self.of(url))

    def apply(self, e):
        """Apply one event and give its answer code."""
        url = e["pdf_link"]
        if e["kind"] == "html_seen":
            self.put(url, classify=2, status="processed")
            return 200
        if e["kind"] == "maybe_pdf":
            self.put(url, classify=2, status="processed", uncertainty=True)
            return 200
        if e["kind"] == "tab_opened":
            known = self.put(url, classify=None, status="processed", uncertainty=False)
            return 200 if known else 400
        if not e["filename"] or not url:
            return 400
        if not self.put(url, uncertainty=False, classify=None):
            return 422
        try:
            self._download(e)
        except Failure:
            return 500
        first = self.of(url)[0]
        self.archive.append(
            {"event_id": e["event_id"], "pg_id": first["id"]}
            | {c: first[c] for c in ("pdf_link", "classify", "status", "filename_location", *TAGS)}
        )
        for r in self.of(url):
            if r["status"] == "processed":
                r["status"] = "done"
        return 200

    def _download(self, e):
        url, pred = e["pdf_link"], e["pred"]
        self.put(url, status="processing")
        if pred is None:
            raise Failure
        if pred not in (1, 2, 3):
            return
        self.put(url, classify=pred)
        if pred != 2:
            self.put(url, filename_location=e["filename"])
            first = self.of(url)[0]
            tagged = first["title"] is not None and first["date"] is not None
            if not tagged and not first["title"]:
                answer = _tagger_answer(e["tag_json"])
                if answer:
                    if not isinstance(answer, dict) or any(t not in answer for t in TAGS):
                        raise Failure
                    self.put(url, **{t: _text(answer[t]) for t in TAGS})
        self.put(url, status="processed")
