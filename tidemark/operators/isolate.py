"""Run many checks as one plan, and find the culprit when that fails."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..errors import JOB_ERRORS, first_line


def halves(keys: Sequence) -> list[Sequence]:
    return [keys[:len(keys) // 2], keys[len(keys) // 2:]]


def run_apart(keys: Sequence, run: Callable[[Sequence], DataFrame], fail: Callable[[object, str], None],
              split: Callable[[Sequence], list[Sequence]] = halves) -> list[DataFrame]:
    """Materialised results of ``run`` over all ``keys``.

    ``run`` must execute (a checkpoint, say). When it fails its keys are split, into halves unless ``split`` says
    otherwise, so that only the culprits, reported to ``fail`` with the reason, are run again and again: about
    log2(n) times each.
    """
    if not keys:
        return []
    try:
        return [run(keys)]
    except JOB_ERRORS as error:
        if len(keys) == 1:
            fail(keys[0], first_line(error))
            return []
    return [found for part in split(keys) for found in run_apart(part, run, fail, split)]
