import csv
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from formspark.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="formspark-tests")
    yield s


# The header of an export file.
HEADER = ["target_id", "target_secret_id", "target_nickname", "target_tag", "source_id", "source_secret_id",
          "source_nickname", "source_tag", "source_relation", "input_id", "input_secret_id", "input_nickname",
          "userId", "secret_user_id", "legacy_user_id", "applet_version", "activity_flow_id", "activity_flow_name",
          "activity_flow_submission_id", "activity_id", "activity_name", "activity_submission_id",
          "activity_start_time", "activity_end_time", "activity_schedule_id", "activity_schedule_history_id",
          "activity_schedule_start_time", "utc_timezone_offset", "activity_submission_review_id", "item_id",
          "item_name", "item_prompt", "item_response_options", "item_response", "item_response_status",
          "item_type", "rawScore"]


def _row(sub, tgt, src, item, name, typ, opts, answer):
    v = {h: "" for h in HEADER}
    v.update({
        "target_id": f"t-{tgt}", "target_secret_id": f"T{tgt}", "target_nickname": f"Kid {tgt}", "target_tag": "kid",
        "source_id": f"s-{src}", "source_secret_id": f"S{src}", "source_nickname": f"Carer {src}",
        "source_tag": "carer", "source_relation": "admin" if src == 1 else "",
        "input_id": "in-1", "input_secret_id": "I1", "input_nickname": "Desk", "userId": "acct-1",
        "secret_user_id": "A1", "applet_version": "1.10", "activity_id": "act-1", "activity_name": "Morning",
        "activity_submission_id": sub, "activity_start_time": "1749138592012", "activity_end_time": "1749138692012",
        "activity_schedule_id": "sch", "activity_schedule_history_id": "sch_20250506-1",
        "activity_schedule_start_time": "not scheduled", "utc_timezone_offset": "-240", "item_id": item,
        "item_name": name, "item_prompt": f"Question {name}, \"quoted\"", "item_response_options": opts,
        "item_response": answer, "item_response_status": "completed", "item_type": typ, "rawScore": "12",
    })
    return [v[h] for h in HEADER]


def write_export(path, rows, header=HEADER, bom=True):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)


OPTS = "Never: 0 (score: 1), Sometimes: 1 (score: 2), Often: 2 (score: 3)"


@pytest.fixture()
def export_dir(tmp_path):
    rows = [
        _row("sub-1", 1, 1, "i1", "sleep_q", "singleSelect", OPTS, "value: 2"),
        _row("sub-1", 1, 1, "i2", "feel", "text", "", "Tired but\nfine, \"really\""),
        _row("sub-1", 1, 1, "i3", "foods", "multiSelect", "apple: 0, pear: 1", "value: 0, 1"),
        _row("sub-2", 2, 2, "i1", "sleep_q", "singleSelect", OPTS, "value: null"),
        _row("sub-2", 2, 2, "i3", "foods", "multiSelect", "apple: 0, pear: 1", "value: 1"),
    ]
    write_export(tmp_path / "applet_responses_1.csv", rows)
    # A second file with a different column order and an extra column.
    hdr2 = list(reversed(HEADER)) + ["subscale_name_mood"]
    r2 = [list(reversed(_row("sub-3", 3, 2, "i1", "sleep_q", "singleSelect", OPTS, "value: 0"))) + ["2.5"]]
    write_export(tmp_path / "applet_responses_2.csv", r2, header=hdr2, bom=False)
    (tmp_path / "notes.txt").write_text("ignored")
    return tmp_path


