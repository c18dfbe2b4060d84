from threadloom.llm.memory import Memory, keep_only


def test_keys_are_worked_out_once_and_common_ones_stay():
    asked = []
    memory = Memory(lambda keys: [asked.append(k) or k.upper() for k in keys], 4, 3)
    assert memory.of({"a", "b"}) == {"a": "A", "b": "B"}
    memory.of({"a", "c"})
    assert sorted(asked) == ["a", "b", "c"]
    memory.of({"a", "d", "e"})  # a new generation; "a" comes back from the old one
    assert sorted(asked) == ["a", "b", "c", "d", "e"]
    assert memory.of({"longer"})["longer"] == "LONGER"
    assert "longer" not in memory.of({"a"})
    more = memory.of({str(i) for i in range(20)})  # more than it holds
    assert len(more) >= 20 and more["7"] == "7"


def test_a_process_keeps_one_model():
    built = []
    assert keep_only("a", lambda: built.append("a") or [1]) == [1]
    assert keep_only("a", lambda: built.append("again")) == [1]
    assert keep_only("no model") is None
    assert keep_only("a", lambda: [2]) == [2] and built == ["a"]
