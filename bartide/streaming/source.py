"""A live market feed as a streaming source: subscriptions, reconnection, arrival stamps.

``bartide_feed`` reads from any transport: a callable, named as ``module:function``, that opens a connection. A connection
has ``send(dict)`` (login and subscriptions), ``receive(seconds)`` (the next message as text or MessagePack bytes, None if
none came in time) and ``close()``. There is no network in tests; they name a transport of their own.

    spark.readStream.format("bartide_feed").option("transport", "my.ws:connect").option("symbols", "AAA,BBB").load()

A feed can't be read again, so what a batch took is written to the query's folder before it is given out: a batch that is
replayed after a failure gives the same rows. Messages that came while no batch ran are not asked for again; the gap
detector and the archive sync find and fill what is lost."""

from __future__ import annotations

import importlib
import json
import os
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from bartide.streaming.msgpack import decoded

#: Bars by resolution that channels offer; channels without symbols.
RESOLUTIONS = ["1", "3", "5", "15", "30", "1H", "1D", "1W"]
PRIVATE = {"orders", "positions", "account"}


class Subscription:
    """What is asked of a feed: (channel, board, symbol) triples; the same after every reconnection."""

    def __init__(self):
        self.wanted: set[tuple[str, str | None, str | None]] = set()

    def _triples(self, channel: str, symbols, boards) -> set:
        if channel in PRIVATE:
            return {(channel, None, None)}
        names = [s.strip().upper() for s in ([symbols] if isinstance(symbols, str) else symbols or []) if s.strip()]
        if not names:
            raise ValueError(f"channel {channel} needs symbols")
        return {(channel, b, s) for s in names for b in (boards or [None])}

    def subscribe(self, channel: str, symbols=None, boards=None) -> list[dict]:
        """The messages to send for what is new."""
        new = self._triples(channel, symbols, boards) - self.wanted
        self.wanted |= new
        return self._messages("subscribe", new)

    def unsubscribe(self, channel: str, symbols=None, boards=None) -> list[dict]:
        gone = self._triples(channel, symbols, boards) & self.wanted
        self.wanted -= gone
        return self._messages("unsubscribe", gone)

    def again(self) -> list[dict]:
        """The messages that restore everything after a reconnection."""
        return self._messages("subscribe", self.wanted)

    @staticmethod
    def _messages(action: str, triples) -> list[dict]:
        by: dict[tuple, list] = {}
        for channel, board, symbol in sorted(triples, key=lambda t: tuple(x or "" for x in t)):
            by.setdefault((channel, board), []).extend([symbol] if symbol else [])
        return [{"action": action, "channel": c, **({"board": b} if b else {}), **({"symbols": s} if s else {})} for (c, b), s in by.items()]


def backoff(attempt: int, first_s: float = 1.0, most_s: float = 60.0) -> float:
    """Seconds to wait before attempt 1, 2, ...: doubled each time, up to ``most_s``."""
    return min(first_s * 2 ** (attempt - 1), most_s)


class Session:
    """One feed: connects, logs in, subscribes, and does so again when the connection breaks or falls silent."""

    def __init__(self, connect: Callable, subscription: Subscription, login: dict | None = None, silent_s: float = 30.0, attempts: int = 8, sleep: Callable = time.sleep, clock: Callable = time.time):
        self.connect, self.subscription, self.login = connect, subscription, login
        self.silent_s, self.attempts, self.sleep, self.clock = silent_s, attempts, sleep, clock
        self.link, self.heard, self.reconnections = None, 0.0, -1

    def open(self) -> None:
        for n in range(1, self.attempts + 1):
            try:
                self.link = self.connect()
                for message in ([self.login] if self.login else []) + self.subscription.again():
                    self.link.send(message)
                self.heard, self.reconnections = self.clock(), self.reconnections + 1
                return
            except OSError:
                self.close()
                if n == self.attempts:
                    raise
                self.sleep(backoff(n))

    def close(self) -> None:
        link, self.link = self.link, None
        if link is not None:
            try:
                link.close()
            except OSError:
                pass

    @property
    def healthy(self) -> bool:
        return self.link is not None and self.clock() - self.heard < 2 * self.silent_s

    def take(self, most: int, seconds: float) -> Iterator[tuple[str, int]]:
        """(message as JSON text, arrival in microseconds), up to ``most`` or for ``seconds``."""
        until = self.clock() + seconds
        while most > 0 and self.clock() < until:
            if not self.healthy:
                self.close()
                self.open()
            try:
                raw = self.link.receive(max(until - self.clock(), 0.01))
            except OSError:
                self.close()
                continue
            if raw is None:
                continue
            self.heard = self.clock()
            yield as_json(raw), int(self.heard * 1e6)
            most -= 1


def as_json(raw: str | bytes) -> str:
    """A message as JSON text; what can't be decoded stands under ``undecoded``."""
    if isinstance(raw, str):
        return raw
    try:
        return json.dumps(decoded(raw), default=lambda x: x.hex() if isinstance(x, bytes) else str(x))
    except ValueError:
        try:
            return json.dumps(json.loads(raw))
        except ValueError:
            return json.dumps({"undecoded": raw.hex()})


def _named(path: str) -> Callable:
    module, name = path.split(":")
    return getattr(importlib.import_module(module), name)


class FeedReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.folder = options.get("folder")
        if not self.folder:
            raise ValueError("option folder: where batches are kept for replays (a mounted folder)")
        self.most, self.seconds = int(options.get("most", "10000")), float(options.get("seconds", "1"))
        subscription = Subscription()
        boards = [b for b in options.get("boards", "").split(",") if b]
        for channel in options.get("channels", "trade").split(","):
            subscription.subscribe(channel, options.get("symbols", "").split(","), boards)
        login = json.loads(options["login"]) if "login" in options else None
        self.session = Session(_named(options["transport"]), subscription, login)
        os.makedirs(self.folder, exist_ok=True)

    def _file(self, at: int) -> str:
        return os.path.join(self.folder, f"{at:020d}.jsonl")

    def initialOffset(self) -> dict:
        return {"at": 0}

    def read(self, start: dict):
        at = int(start["at"])
        rows = list(self.session.take(self.most, self.seconds))
        if not rows:
            return iter(()), start
        with open(self._file(at) + ".tmp", "w", encoding="utf-8") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.replace(self._file(at) + ".tmp", self._file(at))
        return iter(rows), {"at": at + len(rows)}

    def readBetweenOffsets(self, start: dict, end: dict):
        at, rows = int(start["at"]), []
        while at < int(end["at"]):
            with open(self._file(at), encoding="utf-8") as f:
                part = [tuple(json.loads(line)) for line in f]
            rows += part
            at += len(part)
        return iter(rows)

    def commit(self, end: dict) -> None:
        for name in os.listdir(self.folder):
            if name.endswith(".jsonl") and int(name[:20]) + 1 <= int(end["at"]) and self._whole_before(name, int(end["at"])):
                os.remove(os.path.join(self.folder, name))

    def _whole_before(self, name: str, at: int) -> bool:
        with open(os.path.join(self.folder, name), encoding="utf-8") as f:
            return int(name[:20]) + sum(1 for _ in f) <= at


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bartide_feed"

    def schema(self) -> str:
        return "payload string, received_us long"

    def simpleStreamReader(self, schema) -> FeedReader:
        return FeedReader(self.options)


def feed(spark: SparkSession, transport: str, folder: str, symbols: list[str], channels: list[str] | None = None, boards: list[str] | None = None, **options) -> DataFrame:
    """The feed as a stream: payload, received_at."""
    spark.dataSource.register(FeedSource)
    reader = spark.readStream.format("bartide_feed").option("transport", transport).option("folder", folder).option("symbols", ",".join(symbols))
    reader = reader.option("channels", ",".join(channels or ["trade"])).option("boards", ",".join(boards or []))
    return reader.options(**options).load().select("payload", F.timestamp_micros("received_us").alias("received_at"))
