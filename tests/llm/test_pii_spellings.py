"""One value, one pseudonym, however it is printed."""

import re

import pytest

from paceline.llm import pii


def hidden(text, key=b"key"):
    return pii.pseudonymise(text, key)[0]


def digits(text):
    return re.sub(r"\D", "", text)


@pytest.mark.parametrize("spellings", [
    ["+44 1632 960961", "+441632960961", "0044 1632 960961", "+44 (0)1632 960961", "+44-1632-960961", "+44.1632.960961", "+44(1632)960961"],
    ["+1 (555) 123-4567", "(555) 123-4567", "555-123-4567", "555.123.4567", "+15551234567", "555 123 4567", "001 555 123 4567"],
    ["+49 30 901820", "+4930901820", "0049 30 901820"],
    ["+358 9 1234567", "+35891234567"],
])
def test_phone_numbers_stay_linked_in_every_spelling(spellings):
    got = [hidden(f"call {s} now") for s in spellings]
    numbers = [g.removeprefix("call ").removesuffix(" now") for g in got]
    plain = {re.sub(r"^(\+|00)", "", n.replace("(0)", "")) for n in numbers}
    national = {digits(p)[-len(digits(spellings[0])) + len(re.match(r"\+(\d{1,3})", spellings[0]).group(1)):] for p in plain}
    assert len({n[-9:] for n in national}) == 1 and national != {digits(spellings[0])[-len(next(iter(national))):]}
    for s, n in zip(spellings, numbers):
        assert [c for c in n if not c.isdigit()] == [c for c in s if not c.isdigit()]  # the print stays
        if s.startswith(("+", "00")):
            code = re.match(r"(\+|00)(1|44|49|358)", s)
            assert n.startswith(code.group())  # and so does the country code


def test_links_over_many_numbers():
    """Brute force: different numbers get different pseudonyms, equal ones equal ones, in both prints."""
    numbers = [f"{7000 + i * 37 % 1000:04d}{(i * 7919) % 1_000_000:06d}" for i in range(3000)]
    spaced = [digits(hidden(f"+44 {n[:4]} {n[4:]}")) for n in numbers]
    solid = [digits(hidden(f"+44{n}")) for n in numbers]
    assert spaced == solid and all(p.startswith("44") and len(p) == 12 for p in solid)
    assert len(set(solid)) == len(set(numbers))


def test_what_is_no_phone_number_stays():
    for text in ("sizes 123 456 7890 1234", "+12", "055 123 4567", "00 12 34", "12 555 123 4567", "1000000000"):
        assert hidden(text) == text


@pytest.mark.parametrize("spellings", [["3/7/1985", "03/07/1985", "03.07.1985", "3.7.1985", "1985-07-03", "1985/07/03"],
                                       ["2024/02/29", "2024-02-29", "29.2.2024", "29/02/2024", "2/29/2024"]])
def test_dates_stay_linked_in_every_spelling(spellings):
    def day(text):
        parts = [int(n) for n in re.split(r"\D", text)]
        year = next(n for n in parts if n > 31)
        rest = [n for n in parts if n != year]
        return year, *sorted(rest)

    got = [hidden(s) for s in spellings]
    assert len({day(g) for g in got}) == 1 and day(got[0]) != day(spellings[0])
    assert re.fullmatch(r"\d{4}/\d{2}/\d{2}", next(g for g, s in zip(got, spellings) if re.match(r"\d{4}/", s)))
    assert hidden("32/1/1985") == "32/1/1985" and hidden("1.13.1999") == "1.13.1999" and hidden("2023/02/29") == "2023/02/29"


def test_cards_and_accounts_in_other_prints():
    plain = hidden("4111111111111111")
    assert plain != "4111111111111111"
    for sep in (" ", "-", ".", " ", " "):
        printed = sep.join(["4111", "1111", "1111", "1111"])
        assert digits(hidden(f"card {printed}!")) == plain
    assert hidden("1.234.567.890.123.452") == "1.234.567.890.123.452"
    account = hidden("GB82 WEST 1234 5698 7654 32")
    assert account != "GB82 WEST 1234 5698 7654 32"
    assert hidden("gb82 west 1234 5698 7654 32") == account.lower()
    assert hidden("GB82-WEST-1234-5698-7654-32") == account.replace(" ", "-")
    assert hidden("Gb82 West 1234 5698 7654 32") == "Gb82 West 1234 5698 7654 32"


def test_digits_of_other_scripts_are_text():
    for text in ("٤١١١ 1111 1111 1111", "٢٠٢٤-٠٢-٢٩", "+٤٤ ١٦٣٢ ٩٦٠٩٦١"):
        assert pii.pseudonymise(text, b"key") == (text, {})
