import pytest

from ledgerlake.config import DEFAULT_METHODOLOGY as M, account_rules


def test_unit_choices_map_labels_to_measures():
    assert M.unit_choices("annual") == {"Millones de $ corr.": "valor", "Millones de $ ctes. 2024": "valor_2024",
                                        "Millones de USD": "valor_usd", "% del PIB": "valor_pct_pib"}
    assert M.unit_choices("projection")["Millones de USD"] == "ejecutado_usd"
    assert M.constant_unit_label() == "Millones de $ ctes. 2024"
    with pytest.raises(ValueError):
        M.unit_choices("monthly")


def test_rule_list_is_ordered_and_parametrised():
    rules = account_rules()
    assert [r.fill for r in rules][:2] == ["Ingresos", "Sueldos"]
    stock = [r for r in rules if r.entity is not None]
    assert len(stock) == 1 and stock[0].entity == "ANCAP" and stock[0].items == (3,)
    assert account_rules("R")[8].entity == "R"
