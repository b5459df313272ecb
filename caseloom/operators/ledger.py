"""Answers that a model has given already, kept in the shared folder.

Spark repeats a task whose executor is lost, and with it every call the task had made. A
ledger holds one small file per answered call, named by a digest of model, task, instructions
and prompt; a repeated task finds the answers there and calls only for what is left. A file
appears whole or not at all, and writing one again changes nothing.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid

from caseloom.storage import arrow_uri


class Ledger:
    """A folder of answers; ``folder`` is a Hadoop-style path that all executors share."""

    def __init__(self, folder: str):
        self.folder = folder
        self._system = None

    @staticmethod
    def key(*parts: str) -> str:
        """Parts are told apart by their lengths."""
        digest = hashlib.blake2b(digest_size=20)
        for part in parts:
            data = part.encode("utf-8", "surrogatepass")
            digest.update(len(data).to_bytes(8, "little") + data)
        return digest.hexdigest()

    def _local(self) -> bool:
        return self.folder.startswith("file:") or "://" not in self.folder

    def _place(self, key: str) -> str:
        """Folders by the first letters keep listings short."""
        base = re.sub(r"^file:/+", "/", self.folder) if self._local() else self._store()[1]
        return f"{base}/{key[:3]}/{key}.json"

    def _store(self):
        if self._system is None:
            from pyarrow import fs

            self._system = fs.FileSystem.from_uri(arrow_uri(self.folder))
        return self._system

    def get(self, key: str) -> list | None:
        """What was put under ``key``; None if nothing was, or if it cannot be read."""
        place = self._place(key)
        try:
            if self._local():
                with open(place, encoding="utf-8") as handle:
                    return json.load(handle)
            with self._store()[0].open_input_stream(place) as stream:
                return json.loads(stream.read())
        except (OSError, ValueError):
            return None

    def put(self, key: str, value: list) -> bool:
        """Whether the value could be kept; if not, a repeated task makes the call again."""
        place, data = self._place(key), json.dumps(value).encode()
        try:
            if self._local():
                os.makedirs(os.path.dirname(place), exist_ok=True)
                draft = f"{place}.{uuid.uuid4().hex}"
                with open(draft, "wb") as handle:
                    handle.write(data)
                os.replace(draft, place)
            else:
                system = self._store()[0]
                system.create_dir(os.path.dirname(place), recursive=True)
                with system.open_output_stream(place) as stream:
                    stream.write(data)
        except OSError:
            return False
        return True
