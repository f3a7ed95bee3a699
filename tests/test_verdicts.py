import pytest

from examloom.functions import verdicts as v
from examloom.functions.prompts import parse_candidates


@pytest.mark.parametrize(
    "text, score",
    [
        ("Score: 8", 8), ("score 10", 10), ("**Score: 9**", 9), ("Score: 8/10", 8), ("Score: 7.5", 7),
        ("Score: 85", -1), ("Score: 0", -1), ("Score", -1), ("Score: 11 Score: 5", -1),
        ("Score：8", -1), ("Score: **9**", -1), ("Scores: 8", -1), ("Score: ８", 8),
        ("Score: 99999999999999999999", -1), ("", -1),
    ],
)
def test_single_score(apply, text, score):
    assert apply(v.parse_score, [text]) == [score]


def test_two_scores(apply):
    replies = ["x\nScore: 7\ny\nScore: 12\nScore: 4\nScore: 9", "Score: 3", "none", ""]
    assert [tuple(r) for r in apply(v.parse_two_scores, replies)] == [
        (7, 4), (3, -1), (-1, -1), (-1, -1),
    ]


def test_multi_scores(apply):
    four = "Model 1 Score: 100\nmodel 2 score：3\nModel 2 Score: 4\nModel 9 Score: 1"
    replies = [
        four, "Model 1: 8", "Model 3 - Score 4\n**Model 4 Score:** 6", "Model1Score5 Model 2 Scor 7",
        "Final Ratings: Model 1 Score: 9\nFinal Ratings:\nModel 2 Score: 5", "",
    ]
    assert apply(lambda c: v.parse_multi_scores(c, 2), replies) == [
        {1: 100, 2: 4}, {}, {}, {1: 5, 2: 7}, {2: 5}, {},
    ]


def test_winner_of_n(apply):
    replies = [
        "Winner: Model 2", "winner:model 3", "Winner: Model3", "Winner: Model X", "Winner: 2",
        "Winner: Model 1\nWinner: Model 2", "Winner: Model 99", None,
    ]
    assert apply(v.parse_winner_n, replies) == [2, 3, -1, None, None, 1, 99, None]


def test_winner_ab(apply):
    replies = ["Winner: A", "Winner: B", "Winner: Tie", "Winner: B then Winner: A", "winner: a", ""]
    assert apply(v.parse_winner_ab, replies) == ["A", "B", "Tie", "A", "Tie", "Tie"]


CASES = [
    ('ok {"keep": true, "reason": "r"} end', (True, "r", True)),
    ('{"reason":"x"}', (False, "x", True)),
    ("no braces", (False, "JSON parse failed", False)),
    ("} {", (False, "JSON parse failed", False)),
    ("{'keep': true}", (False, "JSON parse failed", False)),
    ('{"keep":true} and {"b":1}', (False, "JSON parse failed", False)),
    ('{"keep":true},{"b":1}', (False, "JSON parse failed", False)),
    ('{"keep":true,"keep":false}', (False, "", True)),
    ('{"keep":"false"}', (False, "", True)),
    ('{"keep":true,}', (False, "JSON parse failed", False)),
    ('{"keep":true', (False, "JSON parse failed", False)),
    ('```json\n{"keep":\n true, "reason": "多行"}\n```', (True, "多行", True)),
    ("", (False, "JSON parse failed", False)),
    (None, (False, "JSON parse failed", False)),
]


@pytest.mark.parametrize("reply, expected", CASES)
def test_verdict_json(apply, reply, expected):
    assert tuple(apply(v.parse_verdict_json, [reply])[0]) == expected


def test_verdict_json_truthy(apply):
    replies = [
        '{"keep":"false"}', '{"keep":""}', '{"keep":1}', '{"keep":0}', '{"keep":0.0}', '{"keep":null}',
        '{"keep":[]}', '{"keep":[0]}', '{"keep":{}}', '{"keep":{"a":1}}', '{"keep":false}', '{"keep":true}', "{}",
    ]
    got = apply(lambda c: v.parse_verdict_json(c, mode="truthy"), replies)
    assert [r.keep for r in got] == [
        True, False, True, False, False, False, False, True, False, True, False, True, False,
    ]


def test_unknown_mode_is_refused(apply):
    with pytest.raises(ValueError):
        apply(lambda c: v.parse_verdict_json(c, mode="loose"), ["{}"])


def test_candidates(apply):
    replies = [
        '["a {topic}", " b ", "", 5]', '{"a": ["long enough"]}', '"a long string"', "",
        "- abc {topic}\n* -x\n  -- 'quoted line' \n\"zzzzzz\"", "['single quoted list']", None,
        '{"a": 1, "a": 2}', '["one", "two"] and more text', "12345678",
    ]
    assert apply(parse_candidates, replies) == [
        ["a {topic}", "b"], [], [], [],
        ["abc {topic}", "quoted line", "zzzzzz"], ["['single quoted list']"], [],
        [], ['["one", "two"] and more text'], [],
    ]


def test_replies_that_close_their_wrapper_keep_nothing(apply):
    broken = ['{"keep": true}],[{"b": 1}', 'x {"keep": true}]} y', '{"keep": true}, "end": 1}', '{"keep": true}}']
    got = apply(lambda c: v.parse_verdict_json(c), broken)
    assert [(r.keep, r.ok) for r in got] == [(False, False)] * len(broken)
