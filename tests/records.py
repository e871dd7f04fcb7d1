"""Small bundles and frames for tests."""

import json


def bundle(*resources, links=(), **extra):
    entries = [{"resource": r} if r is not None else {} for r in resources]
    return {"resourceType": "Bundle", "id": "b", "link": list(links), "entry": entries, **extra}


def observation(id_="o1", reference="Patient/p1", **fields):
    made = {"resourceType": "Observation", "id": id_, "subject": {"reference": reference}, **fields}
    return {k: v for k, v in made.items() if v is not ...}


def patient(id_="p1", **fields):
    made = {"resourceType": "Patient", "id": id_, **fields}
    return {k: v for k, v in made.items() if v is not ...}


def coded(code, display=None):
    coding = {"code": code} if display is None else {"code": code, "display": display}
    return {"coding": [coding]}


def write(folder, **files):
    """``name=content`` as ``name.json``; text is written as it is."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        text = content if isinstance(content, str) else json.dumps(content, indent=2)
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return str(folder)


def rows(df, *columns):
    found = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in found), key=repr)
