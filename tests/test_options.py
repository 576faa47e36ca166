import pytest

from segstream import options as O


BASE = {"scope": "s", "stream": "t"}


@pytest.mark.parametrize("opts,msg", [
    ({}, "Missing required option 'scope'"),
    ({"scope": "s"}, "Missing required option 'stream'"),
    ({"scope": "", "stream": "t"}, "Missing required option 'scope'"),
    ({**BASE, "default_segment_target_rate_bytes_per_sec": "2048", "default_segment_target_rate_events_per_sec": "3"},
     "Cannot set multiple options for scaling"),
    ({**BASE, "default_retention_duration_milliseconds": "1", "default_retention_size_bytes": "1"},
     "Cannot have multiple retention policy options"),
    ({**BASE, "default_num_segments": "-1"}, "Number of segments needs to be integer and should be at least one"),
    ({**BASE, "default_num_segments": "one"}, "Number of segments needs to be integer and should be at least one"),
    ({**BASE, "default_scale_factor": "1"}, "Scale factor needs to be an integer greater than 1"),
    ({**BASE, "default_segment_target_rate_bytes_per_sec": "1000"}, "Target rate should an integer and should at least be 1024 bytes"),
    ({**BASE, "default_segment_target_rate_events_per_sec": "0"}, "Target rate should be an integer amd should be at least one event per second"),
    ({**BASE, "default_retention_size_bytes": "-5"}, "Retention size should be an integer more than or equal to zero bytes"),
    ({**BASE, "default_retention_duration_milliseconds": "x"}, "Retention time should be an integer morethan or equal to zero milliseconds"),
    ({**BASE, "approx_bytes_per_trigger": "0"}, "Max offset should be of type long more than or equal to one"),
])
def test_validation_messages(opts, msg):
    with pytest.raises(O.OptionError) as e:
        O.validate_options(opts)
    assert str(e.value) == msg


def test_valid_options_and_case_insensitive_keys():
    o = O.validate_options({"SCOPE": "s", "Stream": "t", "Default_Num_Segments": "3"})
    assert o["scope"] == "s" and o["default_num_segments"] == "3"
    # absent segment count is accepted
    O.validate_options(BASE)
    # retention limits are longs
    O.validate_options({**BASE, "default_retention_size_bytes": str(2**40)})


def test_scaling_policies():
    assert O.build_stream_config({"default_num_segments": "3"}).scaling.to_json() == \
        {"kind": "fixed", "target_rate": 0, "scale_factor": 0, "min_segments": 3}
    p = O.build_stream_config({"default_num_segments": "1", "default_scale_factor": "2",
                               "default_segment_target_rate_bytes_per_sec": "1024"}).scaling
    assert (p.kind, p.target_rate, p.scale_factor, p.min_segments) == ("by_data_rate", 1, 2, 1)
    p = O.build_stream_config({"default_num_segments": "1", "default_scale_factor": "2",
                               "default_segment_target_rate_events_per_sec": "20"}).scaling
    assert (p.kind, p.target_rate, p.scale_factor) == ("by_event_rate", 20, 2)
    # a factor without a rate is a fixed policy
    assert O.build_stream_config({"default_num_segments": "4", "default_scale_factor": "2"}).scaling.kind == "fixed"


def test_retention_policies():
    r = O.build_stream_config({"default_retention_duration_milliseconds": "1000"}).retention
    assert (r.kind, r.limit) == ("time", 1000)
    r = O.build_stream_config({"default_retention_size_bytes": "5000"}).retention
    assert (r.kind, r.limit) == ("size", 5000)
    assert O.build_stream_config({}).retention.kind == "none"


def test_positions():
    assert O.parse_position({"p": " earLiEst "}, "p", O.LATEST) == O.EARLIEST
    assert O.parse_position({"p": "laTest"}, "p", O.EARLIEST) == O.LATEST
    assert O.parse_position({"p": "UNBOUNDED"}, "p", O.EARLIEST) == O.UNBOUNDED
    assert O.parse_position({}, "p", O.LATEST) == O.LATEST
    p = O.parse_position({"p": '{"1":20,"0":10}'}, "p", O.LATEST)
    assert p.kind == O.PositionKind.SPECIFIC and p.cut_dict() == {0: 10, 1: 20}


def test_cut_text_roundtrip():
    cut = {2: 30, 0: 10, 1: 20}
    text = O.cut_to_text(cut)
    assert text == '{"0":10,"1":20,"2":30}'
    assert O.cut_from_text(text) == cut
