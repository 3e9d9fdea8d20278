"""Delivery clients for tests."""

import json
import os
import uuid


class FileClient:
    """Test client: appends each body as one line to a file per task; fixed status."""

    def __init__(self, directory: str, status: int = 200, fail_ids: tuple = ()):
        self.directory = directory
        self.status = status
        self.fail_ids = set(fail_ids)
        self._path = os.path.join(directory, f"sent-{uuid.uuid4().hex}.jsonl")

    def post(self, body: str, url: str | None = None) -> int:
        doc = json.loads(body)
        if doc.get("event_id") in self.fail_ids:
            raise ConnectionError("simulated transport failure")
        os.makedirs(self.directory, exist_ok=True)
        with open(self._path, "a") as f:
            f.write(body + "\n")
        return self.status
