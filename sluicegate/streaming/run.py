"""Running a router on a stream."""

from sluicegate.plans.route import route
from sluicegate.streaming.late import hold_unknown
from sluicegate.streaming.ledger import Ledger
from sluicegate.streaming.metrics import observed_batch
from sluicegate.streaming.sinks import run_id, to_batches


def route_batches(
    messages, load_schemas, load_rules, config, write, checkpoint, ledger=None, hold=0, counts=None,
    **options,
):
    """Route every micro-batch with the schemas and rules as they are when it first starts.

    A plain streaming query keeps those of its start; here ``load_schemas`` and ``load_rules`` are called
    once per batch, and what they give is noted in the ledger before the batch is routed.  A batch that is
    replayed gets the same again.  Rules and schemas that did not change are not read into the plan anew.
    ``write(routed, batch_id)`` stores the result and must replace, not repeat, what an earlier attempt of
    the batch wrote.  A batch knows its schema ids, so of a large registry those in use are broadcast.

    ``hold``: seconds for which messages with an unknown schema id wait for their schema (see ``late``).
    ``counts``: a BatchCounts that adds up each batch's numbers from the first action on its rows."""
    base = checkpoint.rstrip("/")
    ledger = ledger or Ledger(f"{base}/ledger")

    def step(batch, batch_id):
        run = run_id(batch)
        settled = ledger.settle(batch.sparkSession, run, batch_id, load_schemas, load_rules, config)
        if hold > 0 and settled.schemas is not None:
            folder = f"{base}/waiting/run={run}"
            batch = hold_unknown(
                batch, settled.schemas, settled.config, folder, batch_id, settled.started, hold
            )
        routed = route(batch, settled.schemas, settled.rules, settled.config)
        if counts is None:
            write(routed, batch_id)
        else:
            observed, done = observed_batch(routed, counts, run, batch_id)
            write(observed, batch_id)
            done()

    return to_batches(messages, step, checkpoint, **options)
