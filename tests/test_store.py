"""What the driver gives back between steps."""

from tallyfold.sources import store


def test_the_driver_gives_memory_back_after_a_step(spark):
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    grown = [spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.long, 25_000_000) for _ in range(4)]
    assert runtime.totalMemory() > 800_000_000
    grown.clear()
    for _ in range(3):  # the first ones let the arrays go
        store.release(spark)
    held = runtime.totalMemory()
    used = held - runtime.freeMemory()
    most = store.FREE_HEAP[1]
    assert held <= used * 100 / (100 - most) + (32 << 20)
    assert store._asked(spark, "DiagnosticCommand", "systemTrimNativeHeap")


def test_a_jvm_without_such_a_command_is_no_error(spark):
    assert not store._asked(spark, "DiagnosticCommand", "noSuchCommand")
