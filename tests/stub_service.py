"""A client for the record service that answers from memory."""

import json
from urllib.parse import parse_qs, urlparse

from rostrum.sources.govinfo import Client, TooManyRequests


class Stub(Client):
    def __init__(self, keys, number):
        super().__init__(keys, first_key=number, open_url=self._answer, sleep=lambda s: None)
        self.busy = 1

    def _answer(self, url, body):
        parts = urlparse(url)
        query = {k: v[0] for k, v in parse_qs(parts.query).items()}
        if self.busy:
            self.busy -= 1
            raise TooManyRequests(2.0)
        path = parts.path
        if path == "/search":
            mark = json.loads(body)["offsetMark"]
            if mark == "*":
                return json.dumps({"results": [{"packageId": "P1"}, {"packageId": "P2"}, {"packageId": ""}], "nextOffsetMark": "m"}).encode()
            return json.dumps({"results": [{"packageId": "P1"}], "nextOffsetMark": None}).encode()
        if path.startswith("/published/"):
            return json.dumps({"packages": [{"packageId": "B" + path.split("/")[2][:4]}]}).encode()
        if path.endswith("/granules"):
            first = query.get("offsetMark") == "*"
            return json.dumps({"granules": [{"granuleId": "G1" if first else "G2"}, {}], "nextOffsetMark": "n" if first else None}).encode()
        if path.endswith("/summary"):
            return b'{"dateIssued": "2001-02-03T00:00:00Z", "title": "T"}'
        if path.endswith("/mods"):
            raise OSError("gone")
        return b"<html><pre>x</pre></html>"


def make(keys, number):
    return Stub(keys, number)
