from weekmart.functions.names import bare_names, safe_name, safe_names


def test_bare_names_keep_qualifier_only_on_clash():
    cols = ["Calendar[calendar_date]", "Goods[fg1_name]", "Agents_hybrid[name]",
            "Price_types[name]", "Doc_types[name]", "[sell_qty]"]
    assert bare_names(cols) == ["calendar_date", "fg1_name", "Agents_hybrid[name]",
                                "Price_types[name]", "Doc_types[name]", "sell_qty"]


def test_safe_name_rules():
    assert safe_name("b__test") == "b_test"
    assert safe_name("") == "col"
    assert safe_name("1x") == "c_1x"
    assert safe_name("__") == "col"
    assert safe_name("Реалізація, грн.") == "Реалізація_грн"
    assert safe_name("Agents_hybrid[name]") == "Agents_hybrid_name"


def test_safe_names_clash_suffix_until_unique():
    out = safe_names(["a", "a!", "a_1"])
    assert len(set(out)) == 3
    assert out[0] == "a" and out[1] == "a_1"
    assert safe_names(["", "1x", "__"]) == ["col", "c_1x", "col_1"]


def test_names_clash_without_regard_to_case():
    assert safe_names(["Name", "name", "NAME_1"]) == ["Name", "name_1", "NAME_1_1"]
    assert bare_names(["A[x]", "B[X]", "C[y]"]) == ["A[x]", "B[X]", "y"]
