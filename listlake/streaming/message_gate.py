"""Trigger messages: drop the malformed and the replayed, work the rest, then mark them done."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listlake.functions.scalars import base64_json
from listlake.operators.joins import unnest
from listlake.sources.ledger import anti_join_ledger, append_ledger, ledger_rows, read_ledger

DAILY = "daily_scraping"


MESSAGE = "data string, messageId string"


def valid_message_id(body: Column, wanted: str = DAILY) -> Column:
    """The id of a JSON object with ``message`` and ``subscription`` whose base64 ``message.data`` is JSON of
    the wanted type; NULL for everything else.

    A message without an id is known by a hash of its body, so that different ones are told apart. The body
    is parsed once, into its keys and their texts, and the message's text once more.
    """
    envelope = F.from_json(body, "map<string,string>")
    message = F.from_json(envelope["message"], MESSAGE)
    # A key may be present with a null value, so the keys themselves are looked up.
    valid = F.map_contains_key(envelope, "subscription") & (base64_json(message["data"], "type") == wanted)
    known = F.coalesce(message["messageId"], F.concat(F.lit("sha256:"), F.sha2(body.cast("binary"), 256)))
    return F.when(valid, known)


def envelope_filter(messages: DataFrame, body: str = "body", wanted: str = DAILY) -> DataFrame:
    """Valid messages with their id.

    The id is generated rather than filtered, as a filter would be pushed below the projection and parse the
    body a second time.
    """
    return unnest(messages, F.array_compact(F.array(valid_message_id(F.col(body), wanted))), "message_id")


def new_messages(valid: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each unprocessed id once. Replays collapse before the shuffle and before the join."""
    return anti_join_ledger(valid.select("message_id").distinct(), ledger, hot=[])


def stream_message_gate(
    messages: DataFrame,
    ledger_path: str,
    checkpoint: str,
    work: Callable[[DataFrame, int], dict | None],
    body: str = "body",
    once: bool = True,
    replay_days: int | None = None,
) -> StreamingQuery:
    """Run ``work(new_ids, batch_id)`` for the new messages of each batch.

    The ledger is appended only after ``work`` returned; the metadata it returns is stored with the
    ids. If it raises, the batch stays unmarked and is delivered again on restart. ``replay_days`` is how
    long the broker may deliver a message again; only the ledger's folders of that time are then read.
    """
    spark = messages.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        valid = envelope_filter(batch, body)
        now = datetime.now(timezone.utc)
        since = None if replay_days is None else (now - timedelta(days=replay_days)).date()
        # The ledger grows in here, so the ids are fixed before it does.
        fresh = new_messages(valid, read_ledger(spark, ledger_path, since)).persist()
        try:
            if fresh.isEmpty():
                return
            metadata = work(fresh, batch_id)
            append_ledger(ledger_rows(fresh, now, metadata), ledger_path)
        finally:
            fresh.unpersist()

    writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
