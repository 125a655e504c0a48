"""Location handling: local folders and object-store prefixes alike."""


def join_path(location, name):
    """``location/name`` with one separator; an empty location leaves ``name`` as it is."""
    if not location:
        return name
    return f"{location.rstrip('/')}/{name}"
