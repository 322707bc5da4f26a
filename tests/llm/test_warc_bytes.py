"""Records as they come back from the archive, against a plain writer of WARC files."""

from __future__ import annotations

import base64
import hashlib
import re

import pytest

from termloom.llm import warc

PAGES = [
    (1, "http://a/é", "<p>one</p>"),
    (2, "http://b", "<p>one</p>"),
    (3, "http://c", "zwölf 🙂\r\n\r\nWARC/1.1"),
    (4, None, None),
    (5, "http://e\r\nX-Page: 9", ""),
    (2, "http://b", "<p>one</p>"),
    (2, "http://other", "<p>one</p>"),
    (1, "http://a/é", "<p>one</p>"),
    (None, "http://n", "<p>one</p>"),
    (None, "http://n", "only here"),
    (None, "http://n", "only here"),
    (7, "http://long", "x" * 300_000),
]


def _shown(url):
    return (url or "").replace("\r", "").replace("\n", "")


def _plain(page, url, payload, first, ids):
    """The record of a row, with the ids that the archive chose."""
    body = payload if page == first else b""
    own, referred = ids
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if page == first else 'revisit'}",
        f"WARC-Record-ID: {own}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_shown(url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}",
    ]
    if page != first:
        lines += [f"WARC-Refers-To: {referred}", f"X-Refers-To-Page: {first}"]
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"X-Page: {page}"] if page is not None else []
    lines += [f"Content-Length: {len(body)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("copies", [1, 10_000])
def test_records_are_those_of_a_plain_writer(spark, tmp_path, copies, monkeypatch):
    monkeypatch.setattr(warc, "COPIES", copies)
    path = str(tmp_path / "archive")
    docs = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    warc.write_archive(docs, path)
    rows = warc.read_bytes(spark, path).collect()
    ids = [r.record_id for r in rows]
    assert len(rows) == len(PAGES) and len(set(ids)) == len(ids)

    expected, firsts = [], {}
    for page, _, html in PAGES:
        if page is not None:
            firsts[html or ""] = min(page, firsts.get(html or "", page))
    left = {}
    for r in rows:
        text = bytes(r.header).decode()
        left.setdefault(tuple(re.findall(r"\r\nX-Page: (\d+)\r\nContent", text)) + (r.sha256,), []).append((r.record_id, text))
    for page, url, html in PAGES:
        payload = (html or "").encode()
        key = (() if page is None else (str(page),)) + (hashlib.sha256(payload).hexdigest(),)
        place = next(k for k, (_, t) in enumerate(left[key]) if f"\r\nWARC-Target-URI: {_shown(url)}\r\n" in t)
        own, text = left[key].pop(place)
        referred = re.findall(r"\r\nWARC-Refers-To: (\S+)\r\n", text)
        first = firsts.get(html or "")
        if referred:
            # It leads to a response of the first page.
            target = next(bytes(r.header).decode() for r in rows if r.record_id == referred[0])
            assert "WARC-Type: response" in target and f"\r\nX-Page: {first}\r\n" in target
        expected.append(_plain(page, url, payload, first, (own, *(referred or [""]))))
    assert sorted(bytes(r.record) for r in rows) == sorted(expected)

    found = sorted(map(tuple, warc.read_records(spark, path).collect()), key=str)
    plain = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        first = firsts.get(html or "")
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        plain.append((page, len(payload), digest, *(("response", None) if page == first else ("revisit", first))))
    assert found == sorted(plain, key=str)


def test_damage_is_an_error(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame(PAGES[:3], "page_id bigint, url string, html string"), path)
    for part, change in [("payloads", "payload"), ("headers", "header")]:
        other = str(tmp_path / part)
        for name in ("payloads", "headers"):
            table = spark.read.parquet(f"{path}/{name}")
            if name == part:
                table = table.withColumn(change, warc.F.encode(warc.F.regexp_replace(warc.F.decode(change, "UTF-8"), "one|Length: 1", "Length: 2"), "UTF-8"))
            table.write.parquet(f"{other}/{name}")
        with pytest.raises(Exception, match="damaged"):
            warc.read_records(spark, other).collect()
