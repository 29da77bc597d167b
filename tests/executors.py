"""Executors that write what they are sent to files, and refuse some of it."""

import os
import time
import uuid


class Recorder:
    def __init__(self, folder, refuse=(), error="refused"):
        self.refuse, self.error = tuple(refuse), error
        self.log = open(os.path.join(folder, uuid.uuid4().hex), "w")

    def execute(self, statement):
        self.log.write(statement + "\n")
        self.log.flush()
        return self.error if any(r in statement for r in self.refuse) else None

    def close(self):
        self.log.close()


class Flaky(Recorder):
    """Refuses the first ``times`` sends of single rows that hold a word."""

    def __init__(self, folder, word, error, times):
        super().__init__(folder)
        self.word, self.message, self.left = word, error, times

    def execute(self, statement):
        super().execute(statement)
        if self.word in statement and self.left > 0:
            self.left -= 1
            return self.message
        return None


class Raising(Recorder):
    """Loses its connection at statements that hold a word."""

    def __init__(self, folder, word):
        super().__init__(folder)
        self.word = word

    def execute(self, statement):
        super().execute(statement)
        if self.word in statement:
            raise ConnectionError("gone")


class Turning(Recorder):
    """Refuses every row that ends in 5, and calls the load off at a word."""

    def __init__(self, folder, word):
        super().__init__(folder)
        self.word = word

    def execute(self, statement):
        super().execute(statement)
        if self.word in statement:
            return "E_BAD_PERMISSION"
        return "refused" if "5_" in statement else None


class Slow:
    """Takes its time, unless a statement calls the load off."""

    def execute(self, statement):
        if "Acme" in statement:
            return "E_BAD_PERMISSION"
        time.sleep(30)


def recorded(folder):
    lines = []
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name)) as f:
            lines += f.read().splitlines()
    return lines


def connections(folder):
    return len(os.listdir(folder))
