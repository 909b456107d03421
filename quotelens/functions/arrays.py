"""Token-id arrays: masks, labels, cuts and padding."""

from pyspark.sql import functions as F

from ..schemas import IGNORED_LABEL, MAX_SEQUENCE


def starts_with(full_ids, prompt_ids):
    """Whether the full ids begin with the prompt ids."""
    return F.slice(full_ids, F.lit(1), F.size(prompt_ids)) == prompt_ids


def truncate(ids, limit=MAX_SEQUENCE):
    return F.slice(ids, 1, limit)


def attention(ids, pad_id):
    """1 for a token, 0 for padding."""
    return F.transform(ids, lambda t: F.when(t == pad_id, 0).otherwise(1))


def loss_labels(full_ids, prompt_ids, pad_id=None):
    """The answer ids, with the prompt and any pad id masked out of the loss."""
    answer = F.slice(full_ids, F.size(prompt_ids) + 1, F.size(full_ids))
    labels = F.concat(F.array_repeat(F.lit(IGNORED_LABEL), F.size(prompt_ids)), answer)
    if pad_id is None:
        return labels
    return F.transform(labels, lambda t: F.when(t == pad_id, IGNORED_LABEL).otherwise(t))


def pad_to(ids, width, value):
    """Right-pad to ``width``; a longer array is left as it is."""
    return F.concat(ids, F.array_repeat(F.lit(value), F.greatest(width - F.size(ids), F.lit(0))))


def padded_width(longest, multiple):
    """Smallest multiple that holds ``longest``."""
    return (F.ceil(longest / multiple) * multiple).cast("int")
