import threading
import time

import pytest

from quadrille.cancel import Cancelled, Token, cancel_scope


def sleepy(batches):
    for b in batches:
        time.sleep(30)
        yield b


def test_cancel_stops_a_running_query(spark):
    token = Token(spark)

    def later():
        time.sleep(8)
        token.cancel()

    threading.Thread(target=later).start()
    began = time.time()
    with pytest.raises(Cancelled), cancel_scope(token):
        spark.range(0, 8, 1, 4).mapInArrow(sleepy, "id long").count()
    assert time.time() - began < 28
    with pytest.raises(Cancelled), cancel_scope(token):
        pass


def test_other_queries_go_on(spark):
    with cancel_scope(Token(spark)):
        assert spark.range(10).count() == 10
    assert spark.range(10).count() == 10
