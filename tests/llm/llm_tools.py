SF = "/root/testdata/sf0.001"


class Groups:
    """Union-find in plain Python."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        while (y := self.up.setdefault(x, x)) != x:
            x = y
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
