from pricepanel.functions import labels, normalize, pnu

__all__ = ["labels", "normalize", "pnu"]
