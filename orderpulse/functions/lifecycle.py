"""Column expressions over the order lifecycle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderpulse import vocabulary as v


def final_status() -> Column:
    """Status of the first reached stage in the order of precedence."""
    reached = [
        F.when(F.col(stage).isNotNull(), F.lit(status))
        for stage, status in v.STATUS_BY_STAGE.items()
    ]
    return F.coalesce(*reached, F.lit("unknown"))


def is_legal_step(previous: Column, current: Column) -> Column:
    """Whether `current` may follow `previous` (NULL: `current` opens the order)."""
    legal = previous.isNull() & (current == v.FIRST_EVENT)
    for event_type, followers in v.NEXT_EVENTS.items():
        legal = legal | ((previous == event_type) & current.isin(*followers))
    return F.coalesce(legal, F.lit(False))


def cancel_actor(cancelled_by: Column) -> Column:
    return F.when(cancelled_by.isin(*v.CANCEL_ACTORS), cancelled_by).otherwise(v.OTHER_ACTOR)


def actor_rank(actor: Column) -> Column:
    order = F.array(*[F.lit(name) for name in (*v.CANCEL_ACTORS, v.OTHER_ACTOR)])
    return F.array_position(order, actor).cast("int")


def readable(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(" "))
