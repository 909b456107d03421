"""Chat prompts, answer text and small string helpers."""

from pyspark.sql import functions as F

# Turn markers of the chat format.
OPEN = "<|im_start|>"
CLOSE = "<|im_end|>"
CHAT_PATTERN = (
    r"(?s)<\|im_start\|>system\n(.*?)<\|im_end\|>\n"
    r"<\|im_start\|>user\n(.*)<\|im_end\|>\n<\|im_start\|>assistant\n"
)


def _turn(role, content):
    return F.concat(F.lit(f"{OPEN}{role}\n"), content, F.lit(f"{CLOSE}\n"))


def chatml(system, user, assistant=None):
    """Prompt up to the opened assistant turn, or the whole conversation."""
    head = F.concat(_turn("system", system), _turn("user", user))
    if assistant is None:
        return F.concat(head, F.lit(f"{OPEN}assistant\n"))
    return F.concat(head, _turn("assistant", assistant))


def split_chatml(prompt):
    """System and user sections of a rendered prompt; nulls when it is not one."""

    def section(group):
        # The match goes on to the end, so there is one at most and the prompt is searched once.
        return F.get(F.regexp_extract_all(prompt, F.lit(f"{CHAT_PATTERN}.*"), F.lit(group)), 0)

    return F.struct(section(1).alias("system"), section(2).alias("user"))


def messages(system, user, assistant=None):
    """Message list: array of (role, content)."""
    turns = [("system", system), ("user", user)]
    if assistant is not None:
        turns.append(("assistant", assistant))
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns])


def fill_template(template, contract):
    """Put the contract in place of the literal ``{contract}``."""
    return F.replace(template, F.lit("{contract}"), contract)


def join_evidence(evidence, sep=". "):
    """One clause text from an evidence list; a null entry makes the result null."""
    return F.when(
        ~F.exists(evidence, lambda e: e.isNull()), F.array_join(evidence, sep)
    )


def answer_struct(evidence_sep=". ", label_name="label"):
    """The answer of a raw row, with the label under either of its two names."""
    return F.struct(
        F.col("hypothesis_id"),
        F.col("label").alias(label_name),
        F.col("hypothesis"),
        join_evidence(F.col("evidence_texts"), evidence_sep).alias("source_clause"),
    )


def answer_text(evidence_sep="\n"):
    """Older text form of an answer: keys hypothesis, evidence, hypothesis_label."""
    return F.to_json(
        F.struct(
            F.col("hypothesis"),
            join_evidence(F.col("evidence_texts"), evidence_sep).alias("evidence"),
            F.col("label").alias("hypothesis_label"),
        )
    )


def answers_json(answers, wrap=False):
    """Answer list as the assistant turn, bare or under ``Hypotheses``.

    ``to_json`` writes no spaces and keeps non-ASCII characters.
    """
    return F.to_json(F.struct(answers.alias("Hypotheses"))) if wrap else F.to_json(answers)


def cap_output(requested, limit):
    """Requested output length, at most ``limit``."""
    return F.least(requested, F.lit(limit))


def uri_key(uri):
    """Object key of a storage address: everything after scheme and bucket."""
    parts = F.split(uri, "/")
    return F.array_join(F.slice(parts, F.lit(4), F.greatest(F.size(parts) - 3, F.lit(0))), "/")
