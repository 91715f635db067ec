import pytest

from tagloom.llm.tables import ship_package


@pytest.fixture(autouse=True)
def shipped(request):
    if "spark" in request.fixturenames:
        ship_package(request.getfixturevalue("spark"))
