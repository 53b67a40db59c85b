"""Physics categories of a task (F9, R1): by its hashtags, else by the third field of its name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taskspire.functions.names import as_column

# The hashtags of each category, and the parts of names of each.
BY_HASHTAG = {
    "BPhysics": ["charmonium", "jpsi", "bs", "bd", "bminus", "bplus", "charm", "bottom", "bottomonium", "b0"],
    "BTag": ["btagging"],
    "Diboson": ["diboson", "zz", "ww", "wz", "wwbb", "wwll"],
    "DrellYan": ["drellyan", "dy"],
    "Exotic": ["exotic", "monojet", "blackhole", "technicolor", "randallsundrum", "wprime", "zprime", "magneticmonopole", "extradimensions", "warpeded", "randallsundrum", "contactinteraction", "seesaw"],
    "GammaJets": ["photon", "diphoton"],
    "Higgs": ["whiggs", "zhiggs", "mh125", "higgs", "vbf", "smhiggs", "bsmhiggs", "chargedhiggs"],
    "Minbias": ["minbias"],
    "Multijet": ["dijet", "multijet", "qcd"],
    "Performance": ["performance"],
    "SingleParticle": ["singleparticle"],
    "SingleTop": ["singletop"],
    "SUSY": ["bino", "susy", "pmssm", "leptosusy", "rpv", "mssm"],
    "Triboson": ["triplegaugecoupling", "triboson", "zzw", "www"],
    "TTbar": ["ttbar"],
    "TTbarX": ["ttw", "ttz", "ttv", "ttvv", "4top", "ttww"],
    "Upgrade": ["upgrad"],
    "Wjets": ["w"],
    "Zjets": ["z"],
}
BY_NAME = {
    "Exotic": ["4topci"],
    "TTbarX": ["ttbb", "ttgamma", "3top"],
    "Higgs": ["h125", "xhh"],
    "BPhysics": ["upsilon"],
    "Wjets": ["_wenu_"],
    "Multijet": ["jets"],
    "SUSY": ["tanb"],
    "TTbar": ["ttbar", "_tt_"],
    "SingleTop": ["singletop", "_wt", "_wwbb"],
}
NONE = "Uncategorized"


def physics_category(hashtag_list: Column | str, taskname: Column | str) -> Column:
    """All categories of a task, in the order of the lists above. Names of fewer than three fields tell nothing."""
    tags, short = as_column(hashtag_list), F.lower(F.get(F.split(as_column(taskname), r"\."), F.lit(2)))
    own = lambda found: F.filter(F.array(*found), lambda c: c.isNotNull())
    by_tag = own([F.when(F.coalesce(F.arrays_overlap(tags, F.array(*map(F.lit, words))), F.lit(False)), c) for c, words in BY_HASHTAG.items()])
    by_name = own([F.when(F.coalesce(short.rlike("|".join(words)), F.lit(False)), c) for c, words in BY_NAME.items()])
    return F.when(F.size(by_tag) > 0, by_tag).when(F.size(by_name) > 0, by_name).otherwise(F.array(F.lit(NONE)))
