"""formspark: questionnaire-response analytics on Spark DataFrames.

Typical use::

    from formspark import read_export, wide, long_responses
    report = read_export(spark, "s3://bucket/export-folder")
    wide(report).write.parquet(...)
"""

from .operators.grids import attendance, completion, completion_summary
from .operators.normalize import normalize
from .operators.reshape import expand_options, expand_responses, item_response_options, long_report
from .operators.wide import split_wide, wide
from .plans.job import run
from .plans.outputs import (
    available_outputs,
    data_dictionary,
    data_dictionary_full,
    options,
    produce,
    scored_responses,
    users,
)
from .sources.exports import read_export, read_export_frame
from .sources.participants import read_participants

long_responses = expand_responses

__all__ = [
    "attendance", "available_outputs", "completion", "completion_summary", "data_dictionary",
    "data_dictionary_full", "expand_options", "expand_responses", "item_response_options", "long_report",
    "long_responses", "normalize", "options", "produce", "read_export", "read_export_frame",
    "read_participants", "run", "scored_responses", "split_wide", "users", "wide",
]
