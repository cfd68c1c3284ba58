"""Clients that stand in for a model in tests."""

import os
import uuid


class EchoClient:
    """Answers ``{"echo_chars": <len(prompt)>}``; fails, as a remote error would, when the length is a multiple of 97."""

    def complete(self, prompt: str):
        n = len(prompt)
        if n % 97 == 0:
            raise RuntimeError("stub: upstream error")
        text = '{"echo_chars": %d}' % n
        return text, (n + 3) // 4, len(text) // 4


class CountingCalls:
    """Leaves a file in ``folder`` for each call."""

    def __init__(self, folder: str):
        self.folder = folder

    def complete(self, prompt: str):
        open(os.path.join(self.folder, uuid.uuid4().hex), "w").close()
        return "x", 1000, 10
