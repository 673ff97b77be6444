import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from tracequarry.operators import health
from tracequarry.plans import prompts
from tracequarry.sources.models import Endpoint, RequestFailed, chat_model, embedding_model


@pytest.fixture
def server():
    """Answers by script: (status, body) for each request, then 200 with what was asked."""
    asked, script = [], []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            payload = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, payload, self.headers.get("Authorization")))
            if script:
                status, body = script.pop(0)
            elif self.path == "/embeddings":
                status, body = 200, json.dumps({"data": [{"index": i, "embedding": [float(len(t))]} for i, t in reversed(list(enumerate(payload["input"])))]})
            else:
                status, body = 200, json.dumps({"choices": [{"message": {"content": payload["messages"][-1]["content"][::-1]}}]})
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_):
            pass

    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}", asked, script
    http.shutdown()


def endpoint(url, **more):
    slept = []
    return Endpoint(url, "k", health.TokenBucket(1000.0, 1000.0, 0.0), timeouts=(5.0, 5.0, 5.0), sleep=slept.append, **more), slept


def test_embeddings_come_in_the_order_of_texts(server):
    url, asked, _ = server
    assert embedding_model(endpoint(url)[0], "m")(["a", "bbb", "cc"]) == [[1.0], [3.0], [2.0]]
    assert asked[0] == ("/embeddings", {"model": "m", "input": ["a", "bbb", "cc"]}, "Bearer k")


def test_only_outcomes_worth_it_are_tried_again(server):
    url, asked, script = server
    script += [(503, "busy"), (200, "no json"), (200, json.dumps({"choices": [{"message": {"content": "ok"}}]}))]
    assert chat_model(endpoint(url)[0], "m", temperature=0)([{"role": "user", "content": "x"}]) == "ok"
    assert len(asked) == 3 and asked[0][1]["temperature"] == 0
    script += [(400, "maximum context length"), (200, "never")]
    with pytest.raises(RequestFailed) as failed:
        endpoint(url)[0].post("/x", {})
    assert failed.value.outcome == "input_error" and len(asked) == 4
    script.clear()
    script += [(429, "slow")] * 3
    assert chat_model(endpoint(url)[0], "m")([{"role": "user", "content": "x"}]) is None


def test_a_run_of_fatal_errors_stops(server):
    url, asked, script = server
    script += [(401, "key")] * 9
    point, _ = endpoint(url)
    for _ in range(7):
        with pytest.raises(RequestFailed):
            point.post("/x", {})
    assert len(asked) == 5 and point.monitor.reason


def test_no_answer():
    point, _ = endpoint("http://127.0.0.1:9")
    with pytest.raises(RequestFailed) as failed:
        point.post("/x", {})
    assert failed.value.outcome == "transient_error"
    assert health.error_class(TimeoutError()) == "timeout"


def test_judge_and_compiler_on_a_chat_model(server):
    url, asked, _ = server
    model = chat_model(endpoint(url)[0], "m")
    assert prompts.judging(model)({"target_capability": ["c"]}, ["s"]) == prompts.judge_prompt({"target_capability": ["c"]}, ["s"])[::-1]
    assert prompts.asking(model)("decompose", {"question": "abc"}) == "cba"
    assert asked[0][1]["messages"][0]["content"] == prompts.JUDGE


def test_bucket_warms_up():
    bucket = health.TokenBucket(11.0, warmup=10.0)
    assert bucket.wait(0.0) == 0.0
    assert bucket.wait(0.0) == pytest.approx(1.0)  # one a second at first
    assert bucket.rate(5.0) == pytest.approx(6.0) and bucket.rate(99.0) == pytest.approx(11.0)
    assert health.TokenBucket(0.5).rate(3.0) == pytest.approx(0.5)


@pytest.mark.parametrize("status", [200, 204, 400, 401, 402, 403, 404, 422, 429, 500, 501, 502, 503, 504, 302])
@pytest.mark.parametrize("error", ["", "Moderation", "context_length_exceeded"])
def test_one_answer_like_the_column(spark, status, error):
    from pyspark.sql import functions as F

    for bad in (False, True):
        want = spark.range(1).select(health.outcome_class(F.lit(status), F.lit(error), F.lit(bad))).first()[0]
        assert health.answer_class(status, error, bad) == want
